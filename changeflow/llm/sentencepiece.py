"""Encoding into SentencePiece ids by streaming Viterbi, and decoding.

The segmentation with the largest sum of piece scores is found in one pass over the characters. Only
boundaries within the longest piece of the current one can still matter; as soon as all surviving
backpointers lead to one boundary, the ids up to it are committed and forgotten.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import doc_texts, freeing

SPACE = "▁"
#: Chunks that a task remembers; it bounds memory, not results.
MEMO = 400_000
_WORKER: dict = {}


class Pieces:
    """A model's vocabulary: what the library's file says, nothing trained here."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.score = {self.text[i]: (sp.get_score(i), i) for i in normal}
        self.unknown_score = min((s for s, _ in self.score.values()), default=0.0) - 10
        self.byte_id = {int(self.text[i][3:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.longest = max(map(len, self.score), default=1)
        self.window = 4 * self.longest
        self.starts = {p[:k] for p in self.score for k in range(1, len(p) + 1)}
        self.lone = {p for p in self.score if len(p) == 1}
        #: Every beginning of a piece; those that are pieces have their score and id.
        self.known = {p: self.score.get(p) for p in self.starts}
        #: Neighbouring characters within a piece: between any others all paths have a boundary.
        self.joined = {p[k : k + 2] for p in self.score for k in range(len(p) - 1)}
        self.by_chunk = not any(x[1] == SPACE and x[0] != SPACE or "\n" in x for x in self.joined)
        # Nor over the edge of a run of marks that no piece joins with letters, unless one of a few other characters is near.
        pairs = [(c, other) for x in self.joined for c, other in (x, x[::-1]) if not c.isalpha() and c not in (SPACE, "\n")]
        marks = {c for c, _ in pairs} - {c for c, other in pairs if other.isalpha()}
        near = {other for c, other in pairs if c in marks} - marks - {SPACE}
        whole = rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
        of = lambda chars: re.escape("".join(sorted(chars)))
        self.chunks = re.compile(whole).findall
        self.finer = re.compile(rf"\n|{SPACE}*(?:[^{SPACE}\n{of(marks)}]+|[{of(marks)}]+)|{SPACE}+").findall if marks else self.chunks
        self.near = re.compile(f"[{of(near)}]" if near else r"(?!)").search
        self.octets = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else p.replace(SPACE, " ").encode() for i, p in enumerate(self.text)]
        self.memo: dict[str, bytes] = {}

    def stream(self, source: Iterable[str]) -> Iterator[int]:
        """Ids of a text that comes in pieces of any size (spaces already as the model writes them), committed as early as possible."""
        text, at = "", 0
        best, back = [0.0], [(0, -1)]
        for piece in source:
            text += piece
            ids, at, text, best, back = self._advance(text, at, len(text) - self.longest, best, back)
            yield from ids
        yield from self._advance(text, at, len(text), best, back)[0]

    def _advance(self, text: str, at: int, stop: int, best: list, back: list) -> tuple[list[int], int, str, list, list]:
        """Extends all boundaries from ``at`` up to ``stop``: the ids committed, and what is left after the last committed boundary.

        ``text``, ``best`` (scores) and ``back`` (start and id of the last piece) begin at the last committed boundary. Where no
        piece of a surviving path reaches over a boundary, all paths pass it, and the ids up to it are committed. Where that
        doesn't happen for long, the backpointers are followed to the boundary at which they meet.
        """
        get, lone, longest, n = self.known.get, self.lone, self.longest, len(text)
        ids: list[int] = []
        first = 0
        while at < stop:
            here = k = at - first
            mine = best[here]
            if mine is not None:
                size = len(best)
                for end in range(at + 1, min(n, at + longest) + 1):
                    found = get(text[at:end], 0)
                    k += 1
                    if found:
                        total = mine + found[0]
                        if k < size:
                            if best[k] is None or total > best[k]:  # ties stay with the earlier start
                                best[k], back[k] = total, (here, found[1])
                        else:
                            while size < k:
                                best.append(None)
                                back.append((0, -1))
                                size += 1
                            best.append(total)
                            back.append((here, found[1]))
                            size += 1
                    elif found == 0:
                        break
                if text[at] not in lone:
                    if size == here + 1:
                        best.append(None)
                        back.append((0, -1))
                    if best[here + 1] is None or mine + self.unknown_score > best[here + 1]:
                        best[here + 1], back[here + 1] = mine + self.unknown_score, (here, -1)
            at += 1
            here += 1
            if len(best) == here + 1:
                ids += self._path(text, first, here, back)
                first, best, back = at, [0.0], [(0, -1)]
            elif here % self.window == 0 and (to := self._common(here, best, back)):
                ids += self._path(text, first, to, back)
                first, floor = first + to, best[to]
                best = [None if b is None else b - floor for b in best[to:]]
                back = [(b[0] - to, b[1]) for b in back[to:]]
        return ids, at - first, text[first:], best, back

    @staticmethod
    def _common(at: int, best: list, back: list) -> int:
        """The last boundary that all surviving paths pass, 0 if none but the first."""
        live = {k for k in range(at, len(best)) if best[k] is not None}
        while len(live) > 1:
            k = max(live)
            live.remove(k)
            live.add(back[k][0])
        return live.pop() if live else 0

    def _path(self, text: str, first: int, to: int, back: list) -> list[int]:
        ids: list[int] = []
        while to > 0:
            start, piece = back[to]
            if piece >= 0:
                ids.append(piece)
            elif self.byte_id:
                ids += [self.byte_id[b] for b in reversed(text[first + start : first + to].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(self.unknown)
            to = start
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; empty text has none. A stretch over whose ends no piece reaches (blanks, runs of marks)
        is a stream of its own; its ids are remembered."""
        if not text:
            return np.zeros(0, "<i4")
        written = SPACE + text.replace(" ", SPACE)
        if not self.by_chunk:
            return np.array(list(self.stream([written])), "<i4")
        memo, chunks = self.memo, (self.chunks if self.near(written) else self.finer)(written)
        found = list(map(memo.get, chunks))
        if None in found:
            if len(memo) > MEMO:
                memo.clear()
            for k, x in enumerate(found):
                if x is None:
                    c = chunks[k]
                    found[k] = memo.get(c) or memo.setdefault(c, array("i", self._advance(c, 0, len(c), [0.0], [(0, -1)])[0]).tobytes())
        return np.frombuffer(b"".join(found), "<i4")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.octets.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """One for each worker process and file."""
    if path not in _WORKER:
        _WORKER[path] = Pieces(path)
    return _WORKER[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, text_sha256`` of every row, from its whole text.

    ``model`` is the path of a SentencePiece file. Null and empty texts have no ids. Characters
    without a piece become byte pieces, or the unknown id where the model has none. Repeated rows
    and null doc_ids are kept. Other columns are not read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [vocabulary.encode(t.as_py()) for t in part.column(1)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("i4")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))), part.column(2)], names=["doc_id", "ids", "text_sha256"])
        vocabulary.memo = {}  # the process goes on to other tasks

    return doc_texts(docs).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)).mapInArrow(freeing(run), "doc_id long, ids array<int>, text_sha256 string")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, n_ids, ids_crc32, text, text_sha256`` of encoded rows, the text made from the ids alone; null ids are none."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [np.array(x.values.to_numpy(zero_copy_only=False) if x.is_valid else [], "<i4") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(map(len, ids), pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                        pa.array([vocabulary.decode(x.tolist()) for x in ids], pa.string()), part.column(2),
                    ],
                    names=["doc_id", "ids", "n_ids", "ids_crc32", "text", "text_sha256"],
                )

    return encoded.select("doc_id", "ids", "text_sha256").mapInArrow(freeing(run), "doc_id long, ids array<int>, n_ids long, ids_crc32 long, text string, text_sha256 string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, n_ids, ids_crc32, n_chars, round_trip``: encodes, decodes and says whether the text came back.

    ``round_trip`` is false for texts with U+2581 itself, which the format can't tell from a space.
    """
    decoded = decode(encode(docs, model), model)
    return decoded.select("doc_id", "ids", "n_ids", "ids_crc32", F.char_length("text").cast("long").alias("n_chars"), (F.sha2(F.col("text").cast("binary"), 256) == F.col("text_sha256")).alias("round_trip"))
