"""Quality rules, line first: bad lines go, then documents that lost too much go.

A line with a word fails when it
  * repeats an earlier line of the text,
  * is boilerplate: it holds one of ``BOILERPLATE`` (any case) and has at most 30 words,
  * is navigation: three or more ``|``, ``>`` or bullet separators, and these are at least a fifth of its words; or an entry of a
    menu: at most 4 words without a sentence mark at its end, in a run of six or more such lines (lines without a word
    do not end a run),
  * lacks punctuation: over 40 words and no sentence mark of any script in it,
  * is made of symbols: characters of ``[#*$%&|<>]`` are over a tenth of its word characters.
A document is kept if the base rules pass and its lines lost at most half of the words.

Defined cases: a NULL or empty text has no words, fails the base rules and is not kept.
Repeated rows are judged each; other columns are ignored; a NULL id stays NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, over_texts, table

# Phrases of boilerplate lines.
BOILERPLATE = [
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "subscribe to our newsletter", "sign in to", "log in to", "enable javascript", "lorem ipsum",
    "click here", "skip to content", "share this",
]
SYMBOL = r"[#*$%&|<>]"
NAVIGATION = "[|>»›•·]"
# Marks that end sentences or parts of them, of Latin, Greek, Devanagari, Arabic, Armenian, Ethiopic, Khmer,
# Burmese, Tibetan and East Asian scripts; closing signs may follow them.
MARKS = ".!?;:…‽·।॥؟۔؛։።፧៕။༎。！？；：｡"
PUNCTUATION = f"[{MARKS}]"
ENDED = rf"[{MARKS}][\x20\x09-\x0D\x22\x27”’»)\]]*$"
MAX_ENTRY_WORDS = 4
LEAST_ENTRIES = 6
MAX_BOILERPLATE_WORDS = 30
MAX_UNPUNCTUATED_WORDS = 40
MAX_LOST_PERCENT = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_symbol, _navigation, _punctuation, _ended = (re.compile(p) for p in (SYMBOL, NAVIGATION, PUNCTUATION, ENDED))
_boilerplate = re.compile("|".join(re.escape(p) for p in BOILERPLATE), re.ASCII | re.IGNORECASE)

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_bad_lines long, words_left long, cleaned string")


def menu_lines(lines: list[tuple[str, int]]) -> list[bool]:
    """Which lines (with their numbers of words) are entries of a menu."""
    out, run = [], 0
    for line, words in [*lines, ("", MAX_ENTRY_WORDS + 1)]:
        if not words:
            out.append(False)
            continue
        entry = words <= MAX_ENTRY_WORDS and not _ended.search(line)
        if not entry:
            if run >= LEAST_ENTRIES:
                at = len(out) - 1
                while run:
                    if lines[at][1]:
                        out[at] = True
                        run -= 1
                    at -= 1
            run = 0
        else:
            run += 1
        out.append(False)
    return out[:-1]


def bad_line(line: str, words: int, seen: bool, entry: bool = False) -> bool:
    if seen or entry:
        return True
    if words <= MAX_BOILERPLATE_WORDS and _boilerplate.search(line):
        return True
    bars = len(_navigation.findall(line))
    if bars >= 3 and 5 * bars >= words:
        return True
    if words > MAX_UNPUNCTUATED_WORDS and not _punctuation.search(line):
        return True
    symbols = len(_symbol.findall(line))
    return symbols > 0 and 10 * symbols > sum(map(len, WORD.findall(line)))


def repeat_words(words: list[str]) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    first: dict[tuple, int] = {}
    inside = bytearray(len(words))
    for i, window in enumerate(zip(ids, ids[1:], ids[2:])):
        at = first.setdefault(window, i)
        if at != i:
            inside[i:i + 3] = b"\1\1\1"
            inside[at:at + 3] = b"\1\1\1"
    return sum(inside)


def judge(text: str | None) -> tuple:
    """Counts, verdicts and the text without its bad lines."""
    text = text or ""
    words = WORD.findall(text)
    n, seen, kept_lines, bad, dup, left = len(words), set(), [], 0, 0, 0
    lines = [(line, len(WORD.findall(line))) for line in text.split("\n")]
    for (line, count), entry in zip(lines, menu_lines(lines), strict=True):
        if not count:
            kept_lines.append(line)
            continue
        again = line in seen
        seen.add(line)
        dup += again
        if bad_line(line, count, again, entry):
            bad += 1
        else:
            left += count
            kept_lines.append(line)
    repeated = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    kept = not failed and 100 * (n - left) <= MAX_LOST_PERCENT * n
    return (n, sum(map(len, words)), len(_symbol.findall(text)), dup, repeated, failed, kept, bad, left,
            "\n".join(kept_lines))


def clean_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, verdict and the cleaned text."""
    def each(rows):
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                 "n_bad_lines", "words_left", "cleaned"]
        columns = list(zip(*map(judge, rows["text"]), strict=True))
        return {"doc_id": rows["doc_id"], **dict(zip(names, columns, strict=True))}

    return over_texts(df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                      "text", each, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts for every document."""
    return clean_lines(table(spark, sf_dir, "documents")).drop("cleaned")


_QUOTED = "|".join(BOILERPLATE)
ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs),
tri AS (SELECT r, u.i AS i, ws[u.i] || ' ' || ws[u.i + 1] || ' ' || ws[u.i + 2] AS g
        FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS t(d) GROUP BY r),
lines AS (SELECT r, u.i AS i, l[u.i] AS line FROM (SELECT r, string_split(text, chr(10)) AS l FROM docs),
          unnest(range(1, len(l) + 1)) AS u(i)),
lw AS (SELECT r, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
              len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
              len(regexp_extract_all(line, '{SYMBOL}')) AS symbols,
              len(regexp_extract_all(line, '{NAVIGATION}')) AS bars,
              row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again FROM lines),
es AS (SELECT *, n <= {MAX_ENTRY_WORDS} AND NOT regexp_matches(line, '{ENDED}') AS entry FROM lw WHERE n > 0),
isles AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY i)
                    - row_number() OVER (PARTITION BY r, entry ORDER BY i) AS isle FROM es),
runs AS (SELECT *, entry AND count(*) OVER (PARTITION BY r, entry, isle) >= {LEAST_ENTRIES} AS menu FROM isles),
judged AS (SELECT r, n, again,
              again OR menu OR (n <= {MAX_BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{_QUOTED}'))
              OR (bars >= 3 AND 5 * bars >= n)
              OR (n > {MAX_UNPUNCTUATED_WORDS} AND NOT regexp_matches(line, '{PUNCTUATION}'))
              OR (symbols > 0 AND 10 * symbols > chars) AS bad FROM runs),
l AS (SELECT r, count(*) FILTER (again) AS dup, count(*) FILTER (bad) AS bad,
             coalesce(sum(n) FILTER (NOT bad), 0) AS words_left FROM judged GROUP BY r),
f AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '{SYMBOL}')) AS BIGINT) AS n_symbols,
             coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(bad, 0) AS n_bad_lines,
             CAST(coalesce(words_left, 0) AS BIGINT) AS words_left
      FROM w LEFT JOIN rep USING (r) LEFT JOIN l USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
           AND 100 * (n_words - words_left) <= {MAX_LOST_PERCENT} * n_words AS kept, n_bad_lines, words_left
FROM f
"""
