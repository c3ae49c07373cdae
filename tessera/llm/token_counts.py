"""Token counts by field or section, through character offsets.

A whole document is encoded once, so its tokens are those that training sees;
the lengths of the tokens give their spans, which are joined with the spans of
the sections. A token that crosses boundaries belongs to one section by an
explicit rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whose a token that crosses a boundary is: that of its first or last character, or of most of its bytes (the first of equals).
RULES = ("first", "last", "most")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """A byte-level BPE from a file of ranks; built where it is used."""

    def __init__(self, path: str, pattern: str | None = None):
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.pattern, self.encoding = pattern, None
        self.lengths = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"encoding": None}

    def ids(self, text: str) -> np.ndarray:
        if self.encoding is None:
            import tiktoken

            self.encoding = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return np.array(self.encoding.encode_ordinary(text), np.int64)


def byte_offsets(data: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets; those beyond the end become the end."""
    starts = np.append(np.nonzero(data & 0xC0 != 0x80)[0], len(data))
    return starts[np.minimum(chars, len(starts) - 1)]


def attribute(ends: np.ndarray, spans: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each span: ``ends`` are the tokens' ends in bytes, ``spans`` (n, 2) are sorted and apart, in bytes."""
    if not len(spans) or not len(ends):
        return np.zeros(len(spans), np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    at = starts if rule == "first" else ends - 1
    own = np.searchsorted(spans[:, 0], at, "right") - 1
    inside = (own >= 0) & (at < spans[np.maximum(own, 0), 1])
    if rule == "most":
        low = np.searchsorted(spans[:, 1], starts, "right")
        high = np.minimum(np.searchsorted(spans[:, 0], ends, "left"), len(spans))  # spans low..high-1 meet the token
        own, inside = low, high > low
        for t in np.nonzero(high - low > 1)[0]:
            meet = spans[low[t]:high[t]]
            own[t] += int(np.argmax(np.minimum(meet[:, 1], ends[t]) - np.maximum(meet[:, 0], starts[t])))
    return np.bincount(own[inside], minlength=len(spans))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None, rule: str = "first",
                 path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, section, start_char, end_char, n_tokens): one row per section of every row of ``docs``.

    ``spans_col`` holds the sections, an array of structs (start, end) of
    character offsets, end excluded, sorted and without overlap; without it,
    every line with its line end is a section. section counts from 0. The
    counts of a document whose sections leave no gap add up to its tokens; a
    token that by ``rule`` (see :data:`RULES`) belongs to text outside all
    sections counts nowhere.

    A null or empty text has no lines, so no rows by lines; given sections
    count 0 there. A null array has no rows. Repeated rows give equal rows,
    other columns are not read, and an empty table gives an empty one.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    encoder = Encoder(path or ranks_path(), pattern)
    spans_type = "array<struct<start:long,end:long>>"
    given = F.col(spans_col).cast(spans_type) if spans_col else F.lit(None).cast(spans_type)

    def sections(text: str, data: np.ndarray, given: list | None) -> tuple[np.ndarray, np.ndarray]:
        """Spans in characters and in bytes."""
        if spans_col:
            chars = np.array([(s["start"], s["end"]) for s in given or ()], np.int64).reshape(-1, 2)
            return chars, byte_offsets(data, chars)
        cuts = np.nonzero(data == 10)[0] + 1
        cuts = np.concatenate([[0], cuts[cuts < len(data)], [len(data)]]) if len(data) else np.zeros(0, np.int64)
        chars = cuts if len(data) == len(text) else np.append(np.cumsum(data & 0xC0 != 0x80), len(text))[cuts - 1] * (cuts > 0)
        return np.column_stack([chars[:-1], chars[1:]]), np.column_stack([cuts[:-1], cuts[1:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = [], []
            for i, text, given_spans in zip(*batch.columns, strict=True):
                t = text.as_py() or ""
                data = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                chars, spans = sections(t, data, given_spans.as_py() if spans_col else None)
                if len(chars):
                    n = attribute(np.cumsum(encoder.lengths[encoder.ids(t)]), spans, rule)
                    ids += [i.as_py()] * len(chars)
                    parts.append(np.column_stack([np.arange(len(chars)), chars, n]))
            if parts:
                rows = np.concatenate(parts)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(rows[:, k]) for k in range(4))],
                                                 ["id", "section", "start_char", "end_char", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), given.alias("spans"))
    return rows.mapInArrow(work, "id long, section long, start_char long, end_char long, n_tokens long").withColumnRenamed("id", id_col)
