"""Review flags of adverts: each is a code and what triggers it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filled, trimmed, words

#: Patterns of the review rules, in the order in which flags are raised. `i`: any case.
RESIDUE = (
    ("markup_residue", "i", r"</?(?:p|div|span|br|li|ul|ol|a|strong|em|script|style|h[1-6])\b[^>]*>"),
    ("script_residue", "i", r"<script\b|\bfunction\s+[A-Za-z_$][\w$]*\s*\([^)]*\)\s*\{|\b(?:document|window)\.[\w$]+\s*\(|\b(?:const|let|var)\s+[A-Za-z_$][\w$]*\s*=[^;\n]+;"),
    ("unresolved_placeholder", "", r"\{\{[^{}\n]+\}\}|\$\{[^{}\n]+\}|\[object Object\]|\A\s*(?:undefined|null|NaN)\s*\z"),
)
SALARY = (("salary_contains_other_fields", "i", r"\b(?:directorate|location|closing\s+date|job\s+reference|contract(?:\s+type)?|working\s+hours)\s*:"),)
ELIGIBILITY = (("explicit_internal_only_requires_eligibility_review", "i", r"\binternal\s+(?:vacancy\s+)?only\b"),)
#: A number instead of a pattern: fewer words than that, or with a leading `=` exactly so many.
SUMMARY = (
    ("unexpanded_description", "i", r"\b(?:read|show|see|view)\s+more\s*(?:\.{3}|…|[.!?])?\s*$"),
    ("possible_truncation_requires_review", "", r"(?:\.{3}|…)\s*$"),
    ("short_requires_semantic_review", "<", "30"),
    ("employer_branding", "i", r"build a rewarding career|doing things differently|be part of something bigger|diverse community\.\s*inclusive research"),
    ("metadata_first", "", r"\bArea\b.*\bLocation\b.*\bSalary\b|\A\s*(?:Contract|Working [Hh]ours|Hours|Location|Salary)\s*:"),
    ("promotional_requires_semantic_review", "i", r"we.ve got an exciting opportunity|we offer.*(?:benefits|pension)|join our.*(?:fantastic|dynamic|excellent)|our vision|creating unforgettable|\AThe University of Nottingham has been providing|\AThis is a great opportunity|\AAre you (?:a |an )?(?:passionate|enthusiastic)"),
    ("requirements_first", "i", r"\A\s*(?:About you|Qualified Teacher Status|Degree in|You (?:must|will need)|Candidates? (?:must|should)|(?:Relevant )?Experience (?:of|in)|Relevant teaching experience|Essential criteria|Clear understanding|Is (?:exceptionally|committed)|Your ideas on)"),
    ("recruitment_or_criteria_prefix_requires_review", "i", r"\A(?:We are looking for|You will have|Be (?:a .*teacher|willing)|Have excellent)"),
    ("truncated_sentence", "i", r"(?:to ensure a high|highest standard of|supporting with|work as part of a|and a|at all)\.$|;\."),
    ("possible_truncation_requires_review", "=", "80"),
    ("metadata_first", "i", r"Hours:.*Contract:.*Salary:|Closing date:.*Interviews:"),
    ("recruitment_prefix_requires_review", "i", r"\b(?:seeking to appoint|seeking a dedicated|are looking for|is seeking)\b|\A37 hours per w\b"),
    ("employer_edi_boilerplate", "i", r"Protected Characteristics|Disability Confident|equality and diversity in.*employment"),
)
#: Reasons shown for codes; others are the code itself in words.
REASONS = {
    "markup_residue": "Text contains HTML tags; check the retained advert evidence.",
    "script_residue": "Text contains script syntax; check which page content was extracted.",
    "unresolved_placeholder": "Text contains an unresolved template or object value.",
    "salary_contains_other_fields": "Salary contains labels from other advert fields.",
    "unexpanded_description": "Summary ends with an expansion control; check for unread role text.",
    "possible_truncation_requires_review": "Summary may be cut short; compare with retained role evidence.",
    "repeated_summary": "Different roles have the same substantial summary; check for generic or copied text.",
    "employer_field_entirely_blank": "This field is blank across at least three employer rows; check whether the source genuinely omits it.",
}
BLANK = "blank_requires_detail_limitation"


#: Texts of which a rule's every match holds one, by code and pattern's place among those of its code; other texts are not searched. Those of rules for any case are
#: in lower case and looked for in the text's `plain` form.
GATES = {
    ("markup_residue", 0): ("<",), ("script_residue", 0): ("<", "{", "(", "="), ("unresolved_placeholder", 0): ("{", "[object", "undefined", "null", "NaN"), ("salary_contains_other_fields", 0): (":",),
    ("explicit_internal_only_requires_eligibility_review", 0): ("internal",), ("unexpanded_description", 0): ("more",), ("possible_truncation_requires_review", 0): ("...", "…"),
    ("employer_branding", 0): ("rewarding career", "doing things differently", "something bigger", "diverse community"), ("metadata_first", 0): (":", "Salary"),
    ("promotional_requires_semantic_review", 0): ("exciting opportunity", "we offer", "join our", "our vision", "creating unforgettable", "the university of nottingham", "this is a great opportunity", "are you "),
    ("truncated_sentence", 0): (";.", "to ensure a high.", "highest standard of.", "supporting with.", "work as part of a.", "and a.", "at all."), ("metadata_first", 1): ("hours:", "closing date:"),
    ("recruitment_prefix_requires_review", 0): ("seeking to appoint", "seeking a dedicated", "are looking for", "is seeking", "37 hours per w"),
    ("employer_edi_boilerplate", 0): ("protected characteristics", "disability confident", "equality and diversity in"),
}
#: Letters beyond ASCII that a pattern for any case takes for one of a-z.
LOOSE = {"\u017f": "s", "\u212a": "k", "\u0131": "i", "\u0130": "i"}


def plain(text: Column) -> Column:
    """The text with every letter that a pattern for any case takes for one of a-z as that letter."""
    for letter, base in LOOSE.items():
        text = F.replace(text, F.lit(letter), F.lit(base))
    return F.lower(text)


@dataclass(frozen=True)
class Rules:
    """Rules as one array expression; a text's flags come in rule order without repeats."""

    rules: tuple[tuple[str, str, str], ...]

    def of(self, text: Column) -> Column:
        raised, seen, counted = [], {}, any(how in ("<", "=") for _, how, _ in self.rules)
        whole = F.struct(text.alias("t"), plain(text).alias("low"), (words(text) if counted else F.lit(0)).alias("n"))  # made once

        def test(x: Column, code: str, how: str, p: str) -> Column:
            if how in ("<", "="):
                return x["n"] < int(p) if how == "<" else x["n"] == int(p)
            found = x["t"].rlike(f"(?d{'iuU' if how else 'U'}){p}")
            gate = F.lit(False)
            for needle in GATES.get((code, seen[code]), ()):
                gate |= F.contains(x["low" if how else "t"], F.lit(needle))
            return gate & found if (code, seen[code]) in GATES else found

        def flags_of(x: Column) -> Column:
            seen.clear()
            raised.clear()
            for code, how, p in self.rules:
                seen[code] = seen.get(code, -1) + 1
                raised.append(F.when(test(x, code, how, p), F.lit(code)))
            return F.array_distinct(F.array_compact(F.array(*raised)))

        return F.get(F.transform(F.array(whole), flags_of), F.lit(0))


def text_flags(c: Column | str) -> Column:
    return Rules(RESIDUE).of(filled(c))


def salary_flags(c: Column | str) -> Column:
    return Rules(RESIDUE + SALARY).of(filled(c))


def title_flags(c: Column | str) -> Column:
    return Rules(ELIGIBILITY).of(filled(c))


def summary_flags(c: Column | str) -> Column:
    """A blank summary has one flag only, and no other rule looks at it."""
    x = filled(c)
    return F.when(trimmed(x) == "", F.array(F.lit(BLANK))).otherwise(Rules(RESIDUE + SUMMARY).of(x))


def reason(code: Column | str) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    known = F.create_map(*(F.lit(x) for pair in REASONS.items() for x in pair))
    plain = F.replace(c, F.lit("_"), F.lit(" "))
    return F.coalesce(known[c], F.concat(F.upper(F.substring(plain, 1, 1)), F.lower(F.substring(plain, 2, 1000))))
