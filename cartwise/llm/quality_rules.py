"""Quality rules: a threshold table compiled into one projection.

``measures`` names the counts of a text as SQL expressions and ``RULES`` is a table of
(name, numerator, denominator, least, most): a document passes a rule while
``least <= numerator / denominator <= most``, compared in integers (parts per thousand
of the denominator), so no rounding decides. ``compile_rules`` turns any such table into
expressions over the counts; ``judge`` evaluates counts, failed rules and verdict in one
Spark projection, without a user function, a shuffle or a second scan.

Words are the maximal runs outside ASCII white space. Repeated windows are found inside
the row: each window of eight words is one 64-bit hash chained over its words' hashes; a
text whose hashes are all distinct (``array_distinct``, a hash set) ends there, and only
the others sort (hash, place), flag equal neighbours and add up the places covered.

Bounds: a row holds the words and hashes of its own text, nothing of another row, and no
group is formed, so copies and hot sources cost what their rows cost.

Defined results: null and empty texts and texts of white space have no words, counts of
zero, and fail the rule on length; very long texts are judged whole, in one row; ratios
with a denominator of zero pass; repeated rows are judged each; ties do not occur; an
empty table gives no rows; other columns stay as they are, also where they are named like
a count or a rule (the results are in one new column, whose name the caller chooses, and
which replaces a column of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a window whose repetition counts.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SPACES = r"\t\n\u000B\u000C\r "

#: Frequent function words of English, German, Spanish and French.
STOP_WORDS = ("the", "and", "of", "to", "in", "that", "a", "is", "for", "it", "with", "on", "as", "at", "by",
              "der", "die", "das", "und", "ist", "ein", "eine", "nicht", "mit", "von", "zu", "den",
              "el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "para", "con", "se", "es",
              "le", "les", "des", "et", "une", "pour", "dans", "pas", "du", "au", "qui")

#: (name, numerator, denominator, least, most), the bounds in thousandths of the denominator; None: no bound.
RULES = [
    ("words", "n_words", "1", 20_000, None),
    ("repeated_windows", "n_repeat_words", "n_words", None, 300),
    ("mean_word_length", "word_chars", "n_words", 1_500, 15_000),
    ("symbols_per_word", "n_symbols", "n_words", None, 100),
    ("digit_share", "n_digits", "word_chars", None, 300),
    ("stop_words", "n_stop_words", "n_words", 20, None),
    ("repeated_lines", "n_dup_lines", "n_lines", None, 400),
    ("bullet_lines", "n_bullet_lines", "n_lines", None, 900),
    ("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 300),
]
#: The rules of ``RULES`` that every text must pass first.
BASE_RULES = ("words", "repeated_windows")


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _without(text: str, chars: str) -> str:
    return f"length({text}) - length(translate({text}, '{chars}', ''))"


#: Hashes of the windows: hashes of 1, 2, 4 and 8 words, each of two of the one before.
def _window_hashes(words: str) -> str:
    n = f"size({words})"
    out, width = f"transform({words}, w -> xxhash64(w))", 1
    while width < WINDOW:
        left = f"slice(h, 1, size(h) - {width})"
        right = f"slice(h, {width + 1}, size(h) - {width})"
        out = _let("h", out, f"zip_with({left}, {right}, (a, b) -> xxhash64(a, b))")
        width *= 2
    return f"CASE WHEN {n} < {WINDOW} THEN CAST(array() AS array<bigint>) ELSE {out} END"


#: Places (sorted) of windows whose hash occurs more than once, then the words they cover.
_PLACES = """sort_array(filter(transform(sequence(0, size(p) - 1), j -> CASE
    WHEN (j > 0 AND p[j].h = p[greatest(j - 1, 0)].h)
      OR (j < size(p) - 1 AND p[j].h = p[least(j + 1, size(p) - 1)].h) THEN p[j].i END), i -> i IS NOT NULL))"""
_COVERED = f"""aggregate(zip_with(slice(f, 1, size(f) - 1), slice(f, 2, size(f) - 1), (a, b) -> least(b - a, {WINDOW})),
    {WINDOW}, (s, x) -> s + x)"""
_SORTED = "sort_array(zip_with(hs, sequence(0, size(hs) - 1), (a, b) -> named_struct('h', a, 'i', b)))"
_REPEATED = _let("hs", _window_hashes("ws"), "CASE WHEN size(array_distinct(hs)) = size(hs) THEN 0 ELSE "
                 + _let("p", _SORTED, _let("f", _PLACES, _COVERED)) + " END")


def measures(text: str) -> dict[str, str]:
    """Count name -> SQL over ``ws`` (words), ``ls`` (lines that hold a word) and ``text``."""
    stops = ", ".join(f"'{x}'" for w in STOP_WORDS for x in dict.fromkeys((w, w.capitalize())))
    return {
        "n_words": "size(ws)",
        "word_chars": f"length(translate({text}, '{_SPACES}', ''))",
        "n_symbols": _without(text, SYMBOLS),
        "n_digits": _without(text, "0123456789"),
        "n_stop_words": f"size(filter(ws, w -> w IN ({stops})))",
        "n_lines": "size(ls)",
        "n_dup_lines": "size(ls) - size(array_distinct(ls))",
        "n_bullet_lines": "size(filter(ls, l -> substring(l, 1, 2) IN ('- ', '* ') OR substring(l, 1, 1) = '\\u2022'))",
        "n_ellipsis_lines": "size(filter(ls, l -> endswith(l, '...') OR endswith(l, '\\u2026')))",
        "n_repeat_words": _REPEATED,
    }


def compile_rules(rules, counts: str = "c") -> dict[str, str]:
    """Rule name -> SQL that is true where the rule fails, over the struct ``counts``."""
    out = {}
    for name, num, den, least, most in rules:
        n, d = (x if x.isdigit() else f"{counts}.{x}" for x in (num, den))
        tests = [f"{n} * 1000 {op} {bound} * {d}" for op, bound in (("<", least), (">", most)) if bound is not None]
        out[name] = f"({d} > 0 AND ({' OR '.join(tests)}))" if tests else "false"
    return out


def judged(text_col: str = "text", rules=RULES, base=BASE_RULES) -> Column:
    """A struct of the counts, ``failed`` (names of the failed rules, in table order),
    ``base_failed`` and ``kept``."""
    quoted = f"`{text_col}`"
    text = f"coalesce({quoted}, '')"
    counts = "named_struct(" + ", ".join(f"'{k}', CAST({v} AS BIGINT)" for k, v in measures("t").items()) + ")"
    tests = compile_rules(rules)
    failed = ", ".join(f"CASE WHEN {t} THEN '{k}' END" for k, t in tests.items())
    in_base = " OR ".join(tests[k] for k in base) or "false"
    verdict = (f"named_struct('counts', c, 'failed', array_compact(array({failed})), 'base_failed', {in_base})"
               if rules else "named_struct('counts', c, 'failed', CAST(array() AS array<string>), 'base_failed', false)")
    words = rf"""CASE WHEN btrim(t, '{_SPACES}') = '' THEN CAST(array() AS array<string>)
                 ELSE split(btrim(t, '{_SPACES}'), '[\\x20\\x09-\\x0D]+') END"""
    lines = rf"filter(split(t, '\n'), l -> btrim(l, '{_SPACES}') <> '')"
    body = _let("c", counts, verdict)
    return F.expr(_let("t", text, _let("ws", words, _let("ls", lines, body))))


def judge(df: DataFrame, text_col: str = "text", rules=RULES, base=BASE_RULES, out: str = "quality_rules") -> DataFrame:
    """``df`` with the struct column ``out``: counts, failed, base_failed."""
    return df.withColumn(out, judged(text_col, rules, base))


def keep_by_rules(df: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df`` that fail no rule, with its own columns."""
    return df.where(F.size(judged(text_col, rules, ())["failed"]) == 0)
