"""Token counts by offset-mapped attribution: a document is encoded once, its tokens are then given to its sections.

The tokenizer is byte-level, so its tokens cut the text's UTF-8 bytes without gaps: running lengths give every token's span,
and a byte inside a character belongs to that character. Token spans and section spans are both sorted, so they are
interval-joined by binary search inside the task that encoded the text; no token leaves it.

Rule for a token that crosses a boundary: `start` gives it to the section of its first character (the default), `end` to
that of its last one, `majority` to the section with most of its bytes (the earlier of two equals), and `split` in
proportion to its bytes. Tokens outside every section count in none.

Sections are an array<struct<start: int, end: int>> of characters, ascending and disjoint; by default, and where the array is
null, the lines of a text with their line breaks. Cases: null text and empty text have one empty section without tokens; repeated rows count each;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lumenfold.llm.common import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of this vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space (as the pattern's \\s counts it) from this length on are encoded by themselves.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
RULES = ("start", "end", "majority", "split")


@lru_cache(1)
def encoding(path: str):
    """(encoder, the same without splitting, byte length of every token)."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    lengths[list(ranks.values())] = [len(t) for t in ranks]
    split, whole = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, "(?s:.+)"))
    return split, whole, lengths


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a whole text. Where white space goes on for long, the pattern takes all of it but the last character (all of it at
    the end of the text) as one piece; such a piece is encoded as it stands, since the pattern's look-ahead would trace back over all of it."""
    split, whole, _ = encoding(path)
    parts, at = [], 0
    for m in LONG_BLANK.finditer(text):
        end = m.end() - (m.end() < len(text))
        parts += split.encode_to_numpy(text[at:m.start()], disallowed_special=()), whole.encode_to_numpy(text[m.start():end], disallowed_special=())
        at = end
    parts.append(split.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(parts).astype(np.int64)


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) in characters of the lines of a text, each with its line break; one empty section for an empty text."""
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    ends[-1] -= 1
    if len(ends) > 1 and ends[-1] == ends[-2]:
        ends = ends[:-1]
    return np.concatenate([[0], ends[:-1]]), ends


def shares(ends: np.ndarray, first: np.ndarray, last: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, tokens of it that cross one of its bounds); all spans in bytes, ends: of tokens without gaps."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    n = len(first)
    own, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not len(ends) or not n:
        return own, crossing
    a = np.searchsorted(last, starts, "right")  # first section that ends behind the token's start
    b = np.searchsorted(first, ends, "left") - 1  # last section that starts before its end
    inside = (a == b) & (a < n)
    inside[inside] = (first[a[inside]] <= starts[inside]) & (last[a[inside]] >= ends[inside])
    own += np.bincount(a[inside], minlength=n)
    for t in np.flatnonzero(~inside & (a <= b)):
        s = np.arange(a[t], b[t] + 1)
        part = np.minimum(last[s], ends[t]) - np.maximum(first[s], starts[t])
        s, part = s[part > 0], part[part > 0]
        crossing[s] += 1
        if rule == "split":
            own[s] += part / (ends[t] - starts[t])
        elif rule == "majority" and len(s):
            own[s[part.argmax()]] += 1
        elif rule == "start" and len(s) and first[s[0]] <= starts[t]:
            own[s[0]] += 1
        elif rule == "end" and len(s) and last[s[-1]] >= ends[t]:
            own[s[-1]] += 1
    return own, crossing


def counter(path: str, rule: str):
    def count(batches):
        lengths = encoding(path)[2]
        for batch in batches:
            rows, sections, begins, stops, tokens, crossings = [], [], [], [], [], []
            for r, (t, spans) in enumerate(zip(batch.column("text"), batch.column("sections"))):
                text = t.as_py() or ""
                data = np.frombuffer(text.encode(), np.uint8)
                ids = token_ids(text, path)
                ends = np.cumsum(lengths[ids])
                at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # first byte of each character, and the end
                # a token that ends inside a character counts as ending behind it, the next one as starting there
                ends = np.append(at, len(data))[np.searchsorted(at, ends, "left")] if len(ends) else ends
                first, last = lines(text) if spans.as_py() is None else (spans.values.field(x).to_numpy() for x in ("start", "end"))
                own, crossing = shares(ends, at[np.minimum(first, len(at) - 1)], at[np.minimum(last, len(at) - 1)], rule)
                rows.append(np.full(len(first), r))
                sections.append(np.arange(len(first)))
                begins.append(first)
                stops.append(last)
                tokens.append(own)
                crossings.append(crossing)
            if rows:
                out = [np.concatenate(x) for x in (rows, sections, begins, stops, tokens, crossings)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(out[0])), *[pa.array(x.astype(np.int64)) for x in out[1:4]],
                     pa.array(out[4].astype(float)), pa.array(out[5].astype(np.int64))],
                    ["doc_id", "section", "start", "end", "tokens", "crossing"])
    return count


def attribute(docs: DataFrame, sections: Column | None = None, rule: str = "start", path: str = TOKENIZER, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc_id, section, start, end, tokens, crossing): one row for each section of each row of docs."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spans = F.lit(None) if sections is None else sections
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), spans.cast("array<struct<start:int,end:int>>").alias("sections"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counter(path, rule), f"doc_id {kind}, section long, start long, end long, tokens double, crossing long")


def op8(spark, sf_dir) -> DataFrame:
    out = attribute(table(spark, sf_dir, "documents"))
    return out.withColumn("tokens", F.col("tokens").cast("long"))


QUERIES = {"op8_token_counts": op8}
