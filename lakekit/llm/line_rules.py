"""Line-first cleaning: rules judge every line, failing lines go, and documents that lose too much text are rejected."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakekit.llm.common import slices, utf8

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
# Phrases of pages rather than of texts.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "click here",
    "read more",
    "sign up",
    "log in",
    "subscribe to",
    "enable javascript",
    "powered by",
    "skip to content",
    "share on",
)
BOILERPLATE_PATTERN = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
SEPARATORS = re.compile(rb"[|>]|\xc2\xbb|\xc2\xb7|\xe2\x80\xba|\xe2\x80\xa2")
LETTERS = re.compile(rb"[A-Za-z]|[\xc2-\xf4][\x80-\xbf]+")
WINDOW = 5
MAX_SYMBOLS = 0.1  # of a line's characters that aren't blank
MAX_SHOUT = 0.7  # of a line's ASCII letters in upper case, in lines of MIN_SHOUT words
MIN_SHOUT = 4
MAX_EXCLAIM = 0.5  # exclamation marks per word
MIN_SEPARATORS = 3  # of navigation bars
MIN_VARIETY = 0.3  # distinct words by words, in lines of MIN_VARIED words
MIN_VARIED = 12
MAX_BOILERPLATE_WORDS = 30  # longer lines are prose that mentions a phrase
MAX_LOSS = 0.5  # of a document's characters that aren't blank

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that stand twice or more in the text, the first occurrence included."""
    if len(words) <= window:
        return 0
    seen: dict[tuple, int] = {}
    again: set[int] = set()
    for i, w in enumerate(zip(*(islice(words, k, None) for k in range(window)))):
        first = seen.setdefault(w, i)
        if first != i:
            again.add(first)
            again.add(i)
    total = end = 0
    for i in sorted(again):
        total += i + window - max(i, end)
        end = i + window
    return total


def failing(line: bytes) -> bool:
    """True if a line that holds a word breaks a rule by itself."""
    words = line.split()
    solid = sum(map(len, words))
    plain = solid - len(line.translate(None, SYMBOLS + BLANKS))
    if plain > MAX_SYMBOLS * solid:
        return True
    if line.count(b"!") > MAX_EXCLAIM * len(words) and len(words) > 2:
        return True
    if not LETTERS.search(line):
        return True
    if len(words) >= MIN_SHOUT:
        lower = len(line) - len(line.translate(None, LOWER))
        upper = len(line) - len(line.translate(None, UPPER))
        if upper > MAX_SHOUT * (upper + lower):
            return True
    if len(SEPARATORS.findall(line)) >= MIN_SEPARATORS:
        return True
    if len(words) >= MIN_VARIED and len(set(words)) < MIN_VARIETY * len(words):
        return True
    return len(words) <= MAX_BOILERPLATE_WORDS and bool(BOILERPLATE_PATTERN.search(line.lower()))


def clean(text: bytes) -> tuple[tuple[int, ...], bytes, bool]:
    """(statistics, the text without failing lines, whether enough of it is left)."""
    words = text.split()
    solid = sum(map(len, words))
    stats_chars = len(text.decode("utf-8", "replace")) - (len(text) - solid)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    kept, repeated, lost = [], 0, 0
    for line in lines:
        weight = sum(map(len, line.split()))
        if not weight:
            kept.append(line)
            continue
        again = line in seen
        repeated += again
        seen.add(line)
        if again or failing(line):
            lost += weight
        else:
            kept.append(line)
    stats = (len(words), stats_chars, symbols, repeated, repeat_words(words))
    return stats, b"\n".join(kept), 0 < solid and lost <= MAX_LOSS * solid


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of the documents: id, the five statistics, base_failed, kept, and the cleaned text.

    A word is a run without ASCII blanks. A line fails if it repeats an earlier line of its document, consists of symbols
    or shouting, looks like a navigation bar, holds few different words, or is a short line with a boilerplate phrase.
    Failing lines are removed; a document is rejected if it loses more than half of its characters, has no words, or
    fails the base rules (fewer than 10 words, or more than a fifth of them in repeated windows of five). NULL and empty
    texts have zeros, fail the base rules and keep a text as it was. Rows with the same id are judged one by one. Other
    columns don't matter. One pass over whole texts, no shuffle.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(n, T.LongType()) for n in STATS]
        + [
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("kept", T.BooleanType()),
            T.StructField("cleaned", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            stats, failed, kept, cleaned = [], [], [], []
            for text in utf8(batch, "_text"):
                numbers, rest, enough = clean(text)
                bad = numbers[0] < 10 or 100 * numbers[4] > 20 * numbers[0]
                stats.append(numbers)
                failed.append(bad)
                kept.append(enough and not bad)
                cleaned.append(rest.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array([s[i] for s in stats], pa.int64()) for i in range(len(STATS))]
                + [pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(cleaned, pa.string())],
                schema.names,
            )

    chosen = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_text"))
    return chosen.mapInArrow(run, schema)


def oracle(docs: str = "documents") -> str:
    """The statistics in DuckDB SQL, without the method's verdict."""
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM {docs}),
        w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
        win AS (SELECT r, s, array_to_string(words[s : s + 4], ' ') AS g
            FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS s FROM w WHERE len(words) >= 5)),
        rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 5)) AS p FROM
            (SELECT r, s, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1) GROUP BY r),
        lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM w)
            WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r)
        SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
            (len(words) < 10 OR 100 * coalesce(rep.n, 0) > 20 * len(words)) AS base_failed
        FROM w LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)"""
