"""Line and record numbers of files that are split, against readers of whole files."""

import csv
import io
import json
import random

import pytest

from gazetta.sources import feed as feeds
from gazetta.sources import lines


@pytest.fixture(params=[90, 1 << 20])
def splits(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "24"}
    was = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in was.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def field(rng):
    kind = rng.randrange(7)
    plain = "".join(rng.choice("abcü ,1") for _ in range(rng.randint(0, 6)))
    return {0: "", 1: plain, 2: 'quote "in" it', 3: "two\nlines", 4: "cr\r\nlf,\n\n", 5: "x" * rng.randint(0, 90), 6: ' "'}[kind]


def write(path, rows, header, end="\n", blank=()):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(header)
    for k, r in enumerate(rows):
        if k in blank:
            out.write(end + "," * (len(header) - 1) + end)
        w.writerow(r)
    path.write_bytes(out.getvalue().encode())


def strict(spark, folder):
    files = spark.read.format("binaryFile").load(folder)
    return {(r["path"], r["rec_no"]): tuple(r)[5:] for r in feeds.parse_strict(files).collect() if r["problem"] is None}


def test_record_numbers(spark, tmp_path, splits):
    rng = random.Random(splits)
    for name, end, header in (("a", "\n", feeds.SUMMARY_COLUMNS), ("b", "\r\n", feeds.LEGACY_COLUMNS), ("c", "\n", feeds.SUMMARY_COLUMNS)):
        rows = [[field(rng) for _ in header[:-1]] + ["end"] for _ in range(rng.randint(8, 16))]
        write(tmp_path / f"{name}.csv", rows, header, end, blank={0, 3, 4})
    (tmp_path / "d.csv").write_bytes(b"\xef\xbb\xbf" + ",".join(feeds.LEGACY_COLUMNS).encode() + b'\n\n\na"b' + b"," * 14 + b"x")
    got = feeds.read_numbered(spark, str(tmp_path)).collect()
    assert {r["problem"] for r in got} == {None}
    assert {(r["path"], r["rec_no"]): tuple(r)[4:] for r in got} == strict(spark, str(tmp_path))
    assert len(got) == len({(r["path"], r["rec_no"]) for r in got})


def test_problems(spark, tmp_path, splits):
    head = ",".join(feeds.LEGACY_COLUMNS) + "\n"
    good = "v" + "," * 14 + "\n"
    files = {
        "width": head + good + "too,few\n" + good, "cut": head + good + '"never ends' + "\nmore" * 40, "quote": head + good + '"a"b' + "," * 14 + "\n" + good, "header": "a,b\n1,2\n",
        "bytes": (head + good).encode() + b"\xff\n" + good.encode(),
    }
    for name, body in files.items():
        (tmp_path / f"{name}.csv").write_bytes(body if isinstance(body, bytes) else body.encode())
    got = {}
    for r in feeds.read_numbered(spark, str(tmp_path)).collect():
        got.setdefault(r["path"].split("/")[-1][:-4], []).append((r["rec_no"], r["problem"]))
    assert {k: sorted(v) for k, v in got.items()} == {
        "width": [(2, None), (3, "2 fields instead of 15"), (4, None)], "cut": [(2, None), (3, "malformed: unexpected end of data")], "quote": [(2, None), (3, "malformed: ',' expected after '\"'"), (4, None)],
        "header": [(1, "header is neither contract")], "bytes": [(1, "not UTF-8")],
    }


def test_rounds_of_files(spark, tmp_path, splits):
    for k in range(5):
        write(tmp_path / f"{k}.csv", [["two\nlines"] * 16] * (k + 1), feeds.SUMMARY_COLUMNS)
    got = lines.records(spark, str(tmp_path), [feeds.SUMMARY_COLUMNS], most=3).collect()
    assert sorted((r["file"][-5:-4], r["rec_no"]) for r in got) == [(str(k), n + 2) for k in range(5) for n in range(k + 1)]


def test_line_numbers(spark, tmp_path, splits):
    rng = random.Random(3)
    want = {}
    for name in "ab":
        rows = [rng.choice(["", "  ", "{broken", '{"k": 1}', '{"k": "é\\n"}', json.dumps({"k": "x" * 60})]) for _ in range(50)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(rows) + ("\n" if name == "a" else ""))
        want |= {(name, k + 1): r == "{broken" for k, r in enumerate(rows) if r.strip()}
    rows = feeds.read_numbered_lines(spark, str(tmp_path), "k string")
    assert {(r["file"][-7:-6], r["line_no"]): r["_corrupt_record"] is not None for r in rows.collect()} == want
    first = {r["file"][-7:-6]: (r["n"], r["first_line"]) for r in feeds.broken_lines(rows).collect()}
    assert first == {f: (sum(bad for (g, _), bad in want.items() if g == f), min(n for (g, n), bad in want.items() if g == f and bad)) for f in "ab"}
