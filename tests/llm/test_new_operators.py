"""Structure repair, personal data and importance resampling against brute force, on nulls, empty and very long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from gazetta.llm import importance, pii
from gazetta.llm.importance import resample
from gazetta.llm.repair import Dag, damaged, repaired, repairs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cheapest(rows):
    """(cost, audit, output) by all paths; `rows` are (role, text, must go, truncated)."""
    found = []

    def go(i, shape, cost, audit, out, inserts):
        if cost > 2 * len(rows):  # deleting all costs as much
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            found.append((cost, audit, "\n".join(out)))
        if inserts < 3:
            for role in ("user", "assistant"):
                go(i, shape + role[0], cost + 5, audit + "I", [*out, f"{role}:"], inserts + 1)
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            go(i + 1, shape, cost + 2, audit + "D", out, 0)
            if not must_go:
                if role:  # an empty role has no initial to keep
                    go(i + 1, shape + role[:1], cost + 5 * cut, audit + "K", [*out, f"{role}:{text}"], 0)
                for new in ("user", "assistant"):
                    go(i + 1, shape + new[0], cost + 1 + 5 * cut, audit + "R", [*out, f"{new}:{text}"], 0)

    go(0, "", 0, "", [], 0)
    return min(found)


def test_edits_are_the_cheapest():
    rng = random.Random(5)
    for _ in range(250):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{k}.", rng.random() < 0.2, rng.random() < 0.25) for k in range(rng.randint(0, 5))]
        dag = Dag(len(rows))
        for r in rows:
            dag.read(*r)
        cost, audit, out = cheapest(rows)
        assert dag.end() == (cost, audit, sha(out)), rows


def test_long_conversation():
    dag = Dag(3000)
    for k in range(3000):
        dag.read("user" if k % 2 == 0 else "assistant", f"{k}.", k % 7 == 0, False)
    cost, audit, _ = dag.end()
    assert len(audit.replace("I", "")) == 3000 and cost > 0


@pytest.fixture
def talks(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 2, "user", "So?"), (1, 3, "assistant", "Thus!"), (2, 0, "user", None), (2, 5, None, "x."), (2, None, "assistant", "first."),
        (3, 0, "user", "same."), (3, 0, "user", "same."), (3, 1, "assistant", "cut"), (None, 1, "system", "Be."), (None, 2, "user", "ü " * 50_000 + "."), (None, 3, "assistant", "ok."), (4, None, "user", " \t\n"),
        (5, 0, "user", "a."), (5, 3, "user", "b."), (5, 3, "user", "a."), (6, 0, "", "no initial."), (6, 1, "assistant", "a."),
    ]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, rows string, k int"), rows


def test_repairs(spark, talks):
    df, rows = talks
    got = {r["conv_id"]: r for r in repairs(df).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))
        seen, told, kinds = set(), [], Counter()
        for _, _, role, text in own:
            role, text = role if role is not None else " ", text if text is not None else " "
            said = text.strip(" \t\n\x0b\x0c\r")
            kind = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "fine"
            seen.add((role, text))
            kinds[kind] += 1
            told.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, out = cheapest(told)
        r = got[conv]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, sha(out))
        assert (r["blank"], r["duplicate"], r["truncated"]) == (kinds["blank"], kinds["duplicate"], kinds["truncated"])
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert r["illegal"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))


def test_repaired_turns_are_what_the_hash_says(spark, talks):
    df, _ = talks
    found = repairs(df)
    out = {}
    for r in repaired(df, found).collect():
        out.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for r in found.collect():
        assert sha("\n".join(t for _, t in sorted(out.get(r["conv_id"], [])))) == r["repaired_sha256"]


def test_lost_rows_leave_their_conversation(spark):
    rows = [(k, 0, "user", "a.") for k in range(60)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    hurt = {r["conv_id"]: r["copies"] for r in damaged(df).collect()}
    mark = lambda k: zlib.crc32(f"{k}:0".encode()) % 20
    assert all(hurt[k] == {0: 0, 3: 2}.get(mark(k), 1) for k in range(60)) and 0 in hurt.values() and 2 in hurt.values()
    got = {r["conv_id"]: r for r in repairs(damaged(df)).collect()}
    assert len(got) == 61
    for k, n in hurt.items():
        if n == 0:
            assert tuple(got[k])[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repairs(df.limit(0)).collect() == []


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20\-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, rx in PATTERNS.items():
        for m in re.finditer(rx, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = lambda c: sum(map(int, str(2 * int(c))))
            ok = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "phone": lambda: 9 <= len(digits) <= 15,
                "card": lambda: 13 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else double(c) for i, c in enumerate(digits[::-1])) % 10 == 0,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("stretch", [5, 1 << 22])
def test_anchor_expansion_equals_the_patterns(monkeypatch, stretch):
    monkeypatch.setattr(pii, "STRETCH", stretch)
    rng = random.Random(stretch)
    for _ in range(6000):
        letters = rng.choice(["0123456789 -", "01.", "ab@.-+", "+0123 ().-", "a@b.c1+2%", "0.1255 -+@é"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert [s for s in pii.spans(text) if s[0] in pii.BASE] == base_spans(text), text


def test_further_kinds():
    text = "é ftp://bob:pw1@x.org tel:020-7946-0000 IBAN: GB82WEST12345698765432 IBAN GB82WEST12345698765433 account no. 12345678 account 123456789012345678"
    assert [(k, text[a:b]) for k, a, b in pii.spans(text) if k not in pii.BASE] == [("login", "bob:pw1"), ("tel", "020-7946-0000"), ("iban", "GB82WEST12345698765432"), ("account", "12345678")]


def test_personal_data_by_spark(spark):
    texts = [None, "", "me@x.org " * 2000, "é a@b.cd 1.2.3.4 +1 (743) 555-3824; 4111 1111 1111 1111", "9" * 3_000, "x" * 300_000 + "@y.zz", "é a@b.cd"] + ["é a@b.cd"]
    df = spark.createDataFrame([(k if k < 6 else 6, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = pii.report(df).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = base_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert r["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
    out = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    assert out[6] == "é [email]" and out[0] is None and out[3] == "é [email] [ip] [phone]; [card]"
    assert pii.report(df.limit(0)).collect() == []


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, most=2):
    own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return own, [" ".join(own[i : i + n]) for n in range(1, most + 1) for i in range(len(own) - n + 1)]


@pytest.mark.parametrize("stretch", [40, 1 << 20])
@pytest.mark.parametrize("most", [1, 2, 4])
def test_crcs_from_prefixes(monkeypatch, stretch, most):
    monkeypatch.setattr(importance, "STRETCH", stretch)
    rng = random.Random(most)
    texts = [None, "", "a", "A b", "x" * 300 + " y " + "é" * 99, " ".join(rng.choice(["foo", "Bär", "ß", "12", "A" * 40]) for _ in range(200)), "a--b\x00c", "word"]
    got = Counter((int(r), int(c)) for _, row, crc in importance.ngrams(pa.array(texts), most) for r, c in zip(row, crc, strict=True))
    assert got == Counter((k, zlib.crc32(g.encode())) for k, t in enumerate(texts) for g in runs(t, most)[1])
    words = Counter(int(r) for word, _, _ in importance.ngrams(pa.array(texts), most) for r in word)
    assert words == Counter({k: len(runs(t)[0]) for k, t in enumerate(texts) if runs(t)[0]})


def plain_draw(docs, items, buckets, percent):
    s, t = (Counter(zlib.crc32(g.encode()) % buckets for x in texts for g in runs(x)[1]) for texts in ([d[1] for d in docs], items))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for i, text in docs:
        own, grams = runs(text)
        weight = sum(gain(zlib.crc32(g.encode()) % buckets) for g in grams) // len(grams) if grams else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        out.append([i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(own)])
    order = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(order[: len(order) * percent // 100])}
    return Counter((*r[:4], drawn.get(id(r))) for r in out)


def test_resample(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(k, prose(rng.choice([0, 3, 19, 20, 21, 60]))) for k in range(300)] + [(400, None), (401, ""), (None, prose(30)), (402, prose(60_000)), (403, "Ä-B" * 30)]
    docs += [(500, docs[5][1] or "x")] * 3
    items = [prose(15) for _ in range(20)] + [None]
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, weight string, rank int")
    target = spark.createDataFrame([(t,) for t in items], "text string")
    got = resample(frame, target, buckets=300).collect()
    assert Counter(tuple(r)[:5] for r in got) == plain_draw(docs, items, 300, 25)
    assert resample(frame.limit(0), target).collect() == []
    assert {r["rank"] for r in resample(frame.where("doc_id < 3 or doc_id > 399"), target.limit(0), percent=0).collect()} == {None}
