"""SentencePiece encoding and decoding by a forward pass over a trie of words.

A text is marked (a dummy prefix, spaces as U+2581) and cut before each run of
marks, where no piece can cross. The distinct marked words of a block of
documents are sorted, so that walking down the list is a depth-first walk of
their trie: the forward states of the prefix that a word shares with the one
before it are kept, and only the rest is computed.

In a unigram model a prefix's state is the best score and its last piece
(Viterbi). In a BPE model the best sum of scores is not the segmentation, so
the state is the last piece of the prefix's own segmentation: piece t may end a
prefix exactly if merging the piece before it and t together gives the two back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")
#: Words that a Python worker keeps of the recent ones and as many of those before; pairs of pieces that it keeps.
CACHE = 300_000
#: What this worker has learnt of a vocabulary (by its digest), kept for its next task.
_WARM: dict[str, Pieces] = {}
#: Characters of documents whose words are sorted together.
BLOCK_CHARS = 2_000_000


def marked_words(text: str) -> list[str]:
    """The words of the marked text, each without its first mark."""
    if MARK not in text and "  " not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ") if text else []
    return [w[1:] for w in _WORDS.findall(MARK + text.replace(" ", MARK))]


class Pieces:
    """The vocabulary of a SentencePiece model file."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        if kind not in ("bpe", "unigram"):
            raise ValueError(f"kind must be bpe or unigram, not {kind!r}")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        byte = {i: int(names[i][1:-1], 16) for i in range(len(names)) if sp.is_byte(i)}
        plain = [i for i in range(len(names)) if i not in byte and not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i))]
        self.setup(names, [sp.get_score(i) for i in range(len(names))], byte, plain, sp.unk_id(), kind)

    def warm(self) -> Pieces:
        """This vocabulary, with what earlier tasks of this worker have computed."""
        return _WARM.setdefault(self.digest, self)

    @classmethod
    def of(cls, scores: dict[str, float], kind: str) -> Pieces:
        """A vocabulary of its own, id 0 unknown (for tests)."""
        new = cls.__new__(cls)
        names = ["<unk>", *scores]
        new.setup(names, [0.0, *scores.values()], {}, list(range(1, len(names))), 0, kind)
        return new

    def setup(self, names: list[str], scores: list[float], byte: dict[int, int], plain: list[int], unk: int, kind: str) -> None:
        self.names, self.byte, self.unk, self.kind = names, byte, unk, kind
        # equal pieces with other scores, roles or another kind are another vocabulary
        self.digest = hashlib.sha256(repr((kind, unk, names, scores, sorted(byte.items()), plain)).encode()).hexdigest()
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: scores[i] for i in plain}
        self.long: dict[str, list[int]] = {}  # by four characters: the lengths of the pieces that end in them, longest first
        for p in sorted(self.ids, key=len, reverse=True):
            if len(p) > 3 and len(p) not in (found := self.long.setdefault(p[-4:], [])):
                found.append(len(p))
        self.ends: dict[str, tuple[int, ...]] = {}  # what ``sizes`` has found
        #: two characters that stand side by side in some piece; between others no piece crosses
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.byte_id = {b: i for i, b in byte.items()}
        self.unk_score = min(self.scores.values(), default=0.0) - 10
        self.fits: dict[tuple[str, str], bool] = {}
        self.packed = {p: np.int32(i).tobytes() for p, i in self.ids.items()}
        self.known: dict[str, bytes] = {}  # int32 ids of recent words, which lack their first mark
        self.older: dict[str, bytes] = {}  # those of the words before them

    def merged(self, text: str) -> list[str]:
        """BPE of a short string: the adjacent pair that makes the best piece merges first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stands(self, before: str, piece: str) -> bool:
        """Whether two neighbouring pieces stay as they are when their text is merged."""
        fits = self.fits.get((before, piece))
        if fits is None:
            if len(self.fits) > CACHE:
                self.fits.clear()
            whole = before + piece
            apart = not before or before[-1] + piece[0] not in self.pairs
            fits = self.fits[before, piece] = apart or whole not in self.scores and self.merged(whole) == [before, piece]
        return fits

    def sizes(self, end: str) -> tuple[int, ...]:
        """The lengths over 1 that the last piece of a text may have, longest first, by its last four characters (or fewer, if it has no more)."""
        sizes = self.ends.get(end)
        if sizes is None:
            if len(self.ends) > CACHE:
                self.ends.clear()
            sizes = self.ends[end] = (*self.long.get(end, ()), *(n for n in (3, 2) if n <= len(end) and end[-n:] in self.ids))
        return sizes

    def pack(self, piece: str) -> bytes:
        """The int32 ids of a piece: its own, or those of its bytes, or the unknown one."""
        own = [self.byte_id[b] for b in piece.encode("utf-8", "surrogatepass")] if self.byte_id else [self.unk]
        return np.array(own, np.int32).tobytes()

    def segment(self, words: list[str]) -> Iterator[list[str]]:
        """The pieces of each of the sorted ``words``."""
        ids, fits, ends, bpe = self.ids, self.fits, self.ends, self.kind == "bpe"
        before, last, score = "", [""], [0.0]
        for word in words:
            same = 0
            for a, b in zip(before, word):  # noqa: B905  one may be shorter
                if a != b:
                    break
                same += 1
            del last[same + 1:], score[same + 1:]
            for end in range(same + 1, len(word) + 1):
                four = word[end - 4 if end > 4 else 0:end]
                sizes = ends.get(four)
                if sizes is None:
                    sizes = self.sizes(four)
                best = word[end - 1]  # if no longer piece may end here
                if bpe:
                    for size in sizes:
                        if size <= end and (piece := word[end - size:end]) in ids:
                            before_it = last[end - size]
                            stands = fits.get((before_it, piece))
                            if stands or stands is None and self.stands(before_it, piece):
                                best = piece
                                break
                else:
                    best, top = self.likeliest(word, end, sizes, score)
                    score.append(top)
                last.append(best)
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            yield pieces[::-1]
            before = word

    def likeliest(self, word: str, end: int, sizes: tuple[int, ...], score: list[float]) -> tuple[str, float]:
        """The last piece of the best segmentation of ``word[:end]`` and its score, from the scores of the prefixes."""
        best, top = "", None
        for size in (*sizes, 1):
            piece = word[end - size:end] if size <= end else ""
            if piece and (size == 1 or piece in self.ids):
                found = score[end - size] + self.scores.get(piece, self.unk_score)
                if top is None or found > top:
                    best, top = piece, found
        return best, top

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The int32 ids of each text."""
        marked = [marked_words(t) for t in texts]
        distinct, packed = set().union(*marked), self.packed
        missing = distinct.difference(self.known)
        if len(self.known) + len(missing) > CACHE:
            self.known, self.older, missing = {}, self.known, distinct
        known, older = self.known, self.older
        new = missing.difference(older)
        known.update((word, older[word]) for word in missing.difference(new))  # words in use stay
        fresh = sorted(new)
        for word, pieces in zip(fresh, self.segment([MARK + word for word in fresh]), strict=True):
            known[word] = b"".join([packed.get(p) or self.pack(p) for p in pieces])
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in marked]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 give U+FFFD."""
        byte, names, ids = self.byte, self.names, np.asarray(ids).tolist()
        if byte and not byte.keys().isdisjoint(ids):
            text = b"".join(bytes((byte[i],)) if i in byte else names[i].encode() for i in ids).decode("utf-8", "replace")
        else:
            text = "".join(map(names.__getitem__, ids))
        text = text.replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


def model_path() -> str:
    """The public tokenizers' SentencePiece file, the default of the ``path`` parameters."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, kind: str = "bpe") -> DataFrame:
    """(id, n_tokens long, ids array<int>, round_trip boolean), one row per row of ``docs``.

    round_trip: decoding the ids gives the text back (false only for texts that
    hold U+2581 or lone surrogates). A null text has null ids, 0 tokens and a
    null round_trip; an empty text has no ids. Repeated rows are encoded alike.
    Other columns are not read, and an empty table gives an empty one.
    """
    shipped = Pieces(path or model_path(), kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shipped.warm()
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // BLOCK_CHARS
            cuts = [0, *(np.nonzero(np.diff(size))[0] + 1).tolist(), batch.num_rows]
            for at, end in zip(cuts[:-1], cuts[1:], strict=True):
                texts = batch.column(1).slice(at, end - at).to_pylist()
                ids = pieces.encode([t or "" for t in texts])
                sizes = np.array([len(x) for x in ids], np.int64)
                null = np.array([t is None for t in texts] + [False])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=null)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, end - at), pa.array(sizes),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32())),
                    pa.array([None if t is None else pieces.decode(x) == t for t, x in zip(texts, ids, strict=True)], pa.bool_()),
                ], ["id", "n_tokens", "ids", "round_trip"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, n_tokens long, ids array<int>, round_trip boolean").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``tokens`` (id columns and ids) with ``text``, the decoded ids.

    Null ids give null, empty ids an empty text, an empty table an empty one;
    repeated rows decode alike. A table that already has a ``text`` raises.
    """
    if "text" in tokens.columns:
        raise ValueError("the table already has a column text")
    pieces = Pieces(path or model_path())

    @F.pandas_udf("string")
    def text(ids):
        return ids.map(lambda x: None if x is None else pieces.decode(x))

    return tokens.withColumn("text", text(F.col(ids_col)))
