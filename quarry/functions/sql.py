"""The column expressions of this package as functions of the session's SQL.

:func:`register` creates temporary SQL functions (bodies in SQL, no Python), so that queries written as text
can use them::

    register(spark)
    spark.sql("SELECT fingerprint_key(value), count(*) FROM lines GROUP BY 1")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quarry.functions import text as X


def quoted(s: str) -> str:
    """A SQL string literal, everything but ASCII letters and digits escaped."""
    return "'" + "".join(c if c.isascii() and c.isalnum() else f"\\u{ord(c):04x}" if ord(c) < 0x10000 else f"\\U{ord(c):08x}" for c in s) + "'"


def raw(pattern: str) -> str:
    """A pattern as a raw SQL string literal."""
    if "'" in pattern:
        raise ValueError("the pattern holds a quote")
    return f"r'{pattern}'"


def _nfc_body() -> tuple[str, str, str]:
    """SQL of the three steps of :func:`quarry.functions.text.nfc` for a string ``x``."""
    table = X.composition_map()
    single = {k: v for k, v in table.items() if len(v) == 1}
    several = {k: v for k, v in table.items() if len(v) > 1}
    one = f"translate(x, {quoted(''.join(single))}, {quoted(''.join(single.values()))})"
    pairs = ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in several.items())
    many = (f"CASE WHEN x RLIKE {raw(X._class(several))} THEN array_join(transform(regexp_extract_all(x, {raw('(?s)(.)')}, 1), "
            f"p -> coalesce(try_element_at(map({pairs}), p), p)), '') ELSE x END")
    lead, vowel, trail, syllable = X._LEAD, X._VOWEL, X._TRAIL, X._SYLLABLE
    jamo = (f"((ascii(substring(p, 1, 1)) - {X.LEAD_BASE}) * {X.VOWELS} + ascii(substring(p, 2, 1)) - {X.VOWEL_BASE}) * {X.TRAILS} + {X.HANGUL_BASE}"
            f" + if(length(p) = 3, ascii(substring(p, 3, 1)) - {X.TRAIL_BASE}, 0)")
    both = f"ascii(substring(p, 1, 1)) + ascii(substring(p, 2, 1)) - {X.TRAIL_BASE}"
    character = "decode(unhex(hex({})), 'UTF-16BE')"
    joined = (f"CASE WHEN p RLIKE {raw('^' + lead + vowel)} THEN {character.format(jamo)} "
              f"WHEN p RLIKE {raw('^' + syllable + trail)} AND (ascii(p) - {X.HANGUL_BASE}) % {X.TRAILS} = 0 THEN {character.format(both)} ELSE p END")
    hangul = (f"CASE WHEN x RLIKE {raw(f'{lead}{vowel}|{syllable}{trail}')} THEN array_join(transform(regexp_extract_all(x, "
              f"{raw(f'(?s)({lead}{vowel}{trail}?|{syllable}{trail}|.)')}, 1), p -> {joined}), '') ELSE x END")
    return one, many, hangul


def definitions() -> dict[str, str]:
    """Name and parameters of each function, and its SQL: ``RETURNS ... RETURN ...``."""
    one, many, hangul = _nfc_body()
    string = "RETURNS STRING RETURN "
    return {
        "strip_text(x STRING)": string + f"trim(BOTH {quoted(X.WHITESPACE_CHARS)} FROM x)",
        "drop_non_word(x STRING)": string + f"regexp_replace(x, {raw(X._NON_WORD_JAVA)}, '')",
        "nfc_single(x STRING)": string + one,
        "nfc_several(x STRING)": string + many,
        "nfc_hangul(x STRING)": string + hangul,
        "nfc_text(x STRING)": string + "CASE WHEN x RLIKE r'[^\\x00-\\x{2ff}]' THEN nfc_hangul(nfc_several(nfc_single(x))) ELSE x END",
        "normal_text(x STRING)": string + "nfc_text(drop_non_word(lower(strip_text(x))))",
        "normal_tokens(x STRING)": "RETURNS ARRAY<STRING> RETURN array_remove(split(normal_text(x), ' '), '')",
        "fingerprint_key(x STRING)": string + "array_join(array_sort(array_distinct(normal_tokens(x))), ' ')",
        "sq_dist(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>)":
            "RETURNS DOUBLE RETURN aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, v) -> s + v)",
        "nearest_centre(v ARRAY<DOUBLE>, centres ARRAY<ARRAY<DOUBLE>>)":
            "RETURNS STRUCT<sq_dist: DOUBLE, cid: INT> RETURN array_min(transform(centres, (c, i) -> named_struct('sq_dist', "
            "aggregate(zip_with(v, c, (x, y) -> (x - y) * (x - y)), 0D, (s, w) -> s + w), 'cid', i)))",
    }


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names."""
    names = []
    for head, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} {body}")
        names.append(head.split("(")[0])
    return names
