"""Text expressions: white space, case, escaping, extraction from labels."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the feed's contract counts it: Unicode white space and the four ASCII separators.
SPACE = r"(?U)[\s\x1c-\x1f]"
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """The feed has no nulls: a missing value is the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def trimmed(c: Column | str) -> Column:
    return F.trim(filled(c), F.lit(BLANKS))


def collapsed(c: Column | str) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(filled(c), f"{SPACE}+", " "))


@lru_cache(1)
def fold_table() -> tuple[str, str, dict[str, str], str]:
    """Full case folding by the Unicode data of this Python: letters with one letter for them, those letters, letters with several, and a class of a few ranges that holds these but for `ß`."""
    folds = ((chr(k), chr(k).casefold()) for k in range(sys.maxunicode + 1) if not 0xD800 <= k < 0xE000)
    changed = [(c, f) for c, f in folds if c != f]
    one, several = [(c, f) for c, f in changed if len(f) == 1], {c: f for c, f in changed if len(f) > 1}
    spans: list[list[int]] = []
    for k in sorted(ord(c) for c in several if c != "ß"):
        if spans and k - spans[-1][1] <= 16:
            spans[-1][1] = k
        else:
            spans.append([k, k])
    return "".join(c for c, _ in one), "".join(f for _, f in one), several, "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in spans) + "]"


def folded(c: Column | str) -> Column:
    """Full case folding, letter by letter: `ß` by a replacement, ASCII by the lower case, all else by the fold table; the other letters that become several only where a text may have one."""
    x = F.replace(filled(c), F.lit("ß"), F.lit("ss"))
    letters, other, several, rare = fold_table()
    table = F.create_map(*(F.lit(v) for pair in several.items() for v in pair))
    spelled = F.array_join(F.transform(F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)), lambda k: F.coalesce(F.try_element_at(table, k), k)), "")
    wide = F.when(x.rlike(rare), spelled).otherwise(x)
    return F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(wide, letters, other))


def words(c: Column | str) -> Column:
    """Number of words; the empty text has none."""
    return F.regexp_count(filled(c), F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def blank(c: Column | str) -> Column:
    return trimmed(c) == ""


def shown(*values: Column | str, otherwise: str) -> Column:
    """The first nonempty value, else a fixed text."""
    return F.coalesce(*(F.nullif(filled(v), F.lit("")) for v in values), F.lit(otherwise))


def escaped(c: Column | str) -> Column:
    """HTML text and attribute escaping; the ampersand goes first."""
    out = filled(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def digest(c: Column | str) -> Column:
    return F.sha2(filled(c).cast("binary"), 256)


def heading(n: Column) -> Column:
    """`1 job found`, `2 jobs found`."""
    return F.concat(n.cast("string"), F.when(n == 1, F.lit(" job")).otherwise(F.lit(" jobs")), F.lit(" found"))


def without_label(c: Column | str, label: str) -> Column:
    """The text after a leading label, whatever its case."""
    return F.regexp_replace(filled(c), rf"(?iU)\A{label}\s*", "")


def first_number(c: Column | str, *patterns: str) -> Column:
    """Group 1 of the first pattern that matches, as an integer."""
    x = filled(c)
    return F.coalesce(*(F.when(x.rlike(f"(?iU){p}"), F.regexp_extract(x, f"(?iU){p}", 1).cast("int")) for p in patterns))


def bounded_field(c: Column | str, label: str, stops: list[str]) -> Column:
    """The text after `label:` up to the next stop or the end."""
    ends = "|".join(rf"\s+{s}" for s in stops)
    return F.trim(F.regexp_extract(filled(c), rf"(?iU){label}\s*:\s*(.*?)(?={ends}|\z)", 1))


def order_text(c: Column | str) -> Column:
    """Sort key that ignores case and accents."""
    return F.expr(f"collate({c}, 'UNICODE_CI_AI')") if isinstance(c, str) else F.collate(c, "UNICODE_CI_AI")
