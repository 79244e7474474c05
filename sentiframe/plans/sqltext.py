"""SQL (DuckDB dialect) spellings of the text and label expressions.

These are the oracle-side twins of ``sentiframe.functions``: written
directly from the reference semantics, evaluated per annotation row with no
pre-aggregation, so they check the Spark plans independently.
"""

from __future__ import annotations

from ..constants import (ANALYSIS_PUNCTUATION, ASCII_PUNCTUATION, EMOTION_TO_MOOD, EMOTIONS,
                         MOOD_LABELS, STOPWORDS)

# FIXED VALUES, written for RE2 and on their own: nothing here comes from the Spark side.
_SPACES = (r"\x{9}\x{a}\x{b}\x{c}\x{d}\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}\x{1680}"
           r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{_SPACES}]"
_INK = f"[^{_SPACES}]"
URL = f"(http|www){_INK}+"
LETTERS = r"\p{L}+"
MENTION = r"@[\p{L}\p{N}_]+"
ANALYSIS_URL = f"http{_INK}*|{_INK}*[.]com{_INK}*|{_INK}*www{_INK}*"
ANALYSIS_MENTION = f"{WS}@{_INK}+"
_OUT, _OUT_LINE = r"[^\p{L}\p{N}_]", r"[^\p{L}\p{N}_\n]"
#: Override rules in order: (moods they apply to, pattern, mood they give).
RULES = [
    (["happy"], f"(^|{_OUT})(not|never|no){WS}+(so{WS}+|very{WS}+|really{WS}+)?happy({_OUT}|$)", "sad"),
    (["happy"], f"(^|{_OUT})(not|never|no){WS}+(feeling{WS}+)?good({_OUT}|$)", "sad"),
    (["happy"], f"(^|{_OUT})(but|though|although|however){_OUT_LINE}(.*{_OUT_LINE})?"
                f"(empty|tired|sad|lonely|depressed|terrible|awful|hurt|crying|miserable)({_OUT}|$)", "sad"),
    (["neutral", "happy"], f"(^|{_OUT})(waited|waiting|wasted){_OUT_LINE}(.*{_OUT_LINE})?"
                           f"(cancelled|canceled|cancel|last minute|late|ignored)({_OUT}|$)", "angry"),
]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"


def squash(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {lit(WS + '+')}, ' ', 'g'))"


def strip_social(expr: str) -> str:
    s = f"lower({expr})"
    s = f"regexp_replace({s}, {lit(URL)}, '', 'g')"
    return f"regexp_replace({s}, {lit(MENTION)}, '', 'g')"


def clean_text(expr: str) -> str:
    s = f"translate({strip_social(expr)}, {lit(ASCII_PUNCTUATION)}, '')"
    toks = f"string_split({squash(s)}, ' ')"
    keep = (f"list_filter({toks}, lambda t: regexp_full_match(t, {lit(LETTERS)}) "
            f"AND NOT list_contains({str_list(STOPWORDS)}, t))")
    return f"array_to_string({keep}, ' ')"


def light_clean_text(expr: str) -> str:
    return squash(f"translate({strip_social(expr)}, '#', '')")


def analysis_tokens(expr: str) -> str:
    s = f"lower(coalesce(CAST({expr} AS VARCHAR), ''))"
    s = f"regexp_replace({s}, {lit(ANALYSIS_URL)}, ' ', 'g')"
    s = f"regexp_replace({s}, {lit(ANALYSIS_MENTION)}, ' ', 'g')"
    s = f"translate({s}, {lit(ANALYSIS_PUNCTUATION)}, {lit(' ' * len(ANALYSIS_PUNCTUATION))})"
    return f"list_filter(string_split({squash(s)}, ' '), lambda t: length(t) > 2)"


def single_class(prefix: str = "") -> str:
    parts = ", ".join(f"CASE WHEN {prefix}\"{e}\" = 1 THEN {lit(m)} END"
                      for e, m in EMOTION_TO_MOOD.items())
    arr = f"list_distinct([{parts}])"
    return f"CASE WHEN len({arr}) = 1 THEN {arr}[1] END"


def emotion_columns(labels_expr: str) -> str:
    return ", ".join(f"CAST(list_contains({labels_expr}, {i}) AS INTEGER) AS \"{e}\""
                     for i, e in enumerate(EMOTIONS))


def mood_at(idx_expr: str) -> str:
    """0-based index into the mood list."""
    return f"{str_list(MOOD_LABELS)}[({idx_expr}) + 1]"


def rule_hit(text_expr: str, pred_expr: str) -> str:
    whens = " ".join(
        f"WHEN {pred_expr} IN ({', '.join(lit(m) for m in moods)}) AND regexp_matches(lower({text_expr}), {lit(pattern)}) THEN {i}"
        for i, (moods, pattern, _) in enumerate(RULES, start=1))
    return f"CASE {whens} END"


def apply_rule(rule_expr: str, pred_expr: str) -> str:
    whens = " ".join(f"WHEN {rule_expr} = {i} THEN {lit(mood)}" for i, (_, _, mood) in enumerate(RULES, start=1))
    return f"CASE WHEN {rule_expr} IS NULL THEN {pred_expr} {whens} END"


def folded(vector: str, k: int, c: int) -> str:
    """Sum of the components whose place (from 0) is c modulo k."""
    return f"list_sum([CAST(x AS DOUBLE) FOR x, i IN {vector} IF (i - 1) % {k} = {c}])"
