"""Token ids as binary shards: blocks of ids, transposed into planes, each plane compressed.

Layout of a token store (a folder):

``chunks/``  one row per block: shard, chunk, first_id (position in the shard), n_ids, plane_sizes,
             payload (all planes, one zstandard frame each) and the documents that lie in the block.
``index/``   the chunk index without payloads: shard, chunk, first_id (position in the whole
             store), n_ids, payload_bytes. ``read_range`` finds the blocks of an id range from it.

Shards follow the order of doc_id, so ids of the whole store are one sequence. Rows are kept in
Parquet files since Spark commits those atomically on any file system and repeats lost tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import doc_texts, shuffle_partitions

CHUNKS = (
    "shard int, chunk int, first_id long, n_ids int, plane_sizes array<int>, payload binary, "
    "doc_ids array<long>, doc_starts array<long>, doc_lengths array<long>"
)
SEGMENTS = "doc_id long, start long, n_tokens long, crc long, part_at long, part binary"

#: Bytes of text that a shard, the work of one task, has at most on average.
SHARD_BYTES = 256 << 20
#: A task keeps this many encoded words, then starts afresh; it bounds memory, not results.
MEMO_WORDS = 1_200_000
#: Encoded words that a worker process keeps for its next task; more are forgotten.
KEPT_WORDS = 400_000
#: Texts of about this many characters are encoded together.
GROUP_CHARS = 4_000_000
#: Words of letters encoded in one call.
LINE_WORDS = 100
#: Separators of Python's str.split that a tokenizer does not take for white space.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Latin-1 marks but the apostrophe, which a tokenizer may join with letters.
_MARK = re.escape("".join(c for c in map(chr, range(256)) if not c.isalnum() and not c.isspace() and c != "'"))
_MARKS, _BESIDE = re.compile(f"[{_MARK}]+"), re.compile(f"'[{_MARK}]|[{_MARK}]'")
_WORKER: dict = {}


class WordEncoder:
    """Encodes whole texts with a tokenizer whose words never cross white space, word by word.

    Equal to ``tokenizer.encode(text, add_special_tokens=False)``. The tokenizer sees each word once
    for as long as a worker remembers it. Words are remembered in lower case and apart from marks
    beside them; this holds for Latin-1 texts, where lower case and composition go character by
    character, if the tokenizer ignores case and white space and encodes letters and marks apart,
    which is tried out for every Latin-1 character. Any other text, one that holds an added token of
    the tokenizer (in any case), and every text for a tokenizer that fails, is encoded as it is.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives a worker one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words of letters are encoded many to a call and cut where a token ends a word.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        # Added tokens are found before a text is cut into words.
        added = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()} - {""})
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.memo: dict[str, bytes] = {}
        self.by_word = self._tried()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _tried(self) -> bool:
        word, two = self._ids("ab"), self._ids("cd ab")
        if two != self._ids("cd") + word or any(self._ids(f" cd{c}ab ") != two for c in ("  ", "\n", "\t", "\xa0")):
            return False
        for c in map(chr, range(33, 256)):
            if c.isalpha() and self._ids(f"a{c}b") != self._ids(f"a{c.lower()}b"):
                return False
            if _MARKS.fullmatch(c) and (self._ids(f"ab{c}ab") != word + self._ids(c) + word or self._ids(f"1{c}1") != self._ids("1") + self._ids(c) + self._ids("1")):
                return False
        return True

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_many([text]))

    def encode_many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """New words of all the texts are encoded together."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        apart = [self._apart(low) if self.by_word and self._plain(text) and self._without_added(low := text.lower()) else None for text in texts]
        # The words of all texts, each a place among the distinct ones.
        split = pc.ascii_split_whitespace(pa.array([x or "" for x in apart], pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words, places = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        raw = list(map(self.memo.get, words))
        new = [k for k, x in enumerate(raw) if x is None]
        self._learn([words[k] for k in new if words[k]])
        for k in new:
            raw[k] = self.memo.get(words[k], b"")  # empty: what lies before a blank at a text's beginning
        sizes = np.fromiter(map(len, raw), "i8", len(raw)) // 4
        flat, starts = np.frombuffer(b"".join(raw), dtype="<u4"), np.cumsum(sizes) - sizes
        lengths = sizes[places]
        ends = np.cumsum(lengths)
        ids = flat[np.repeat(starts[places] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        for text, x, start, end in zip(texts, apart, bounds, bounds[1:], strict=False):
            yield np.array(self._ids(text), dtype="<u4") if x is None else ids[start:end]

    def _without_added(self, text: str) -> bool:
        return self.added is None or self.added.search(text) is None

    @staticmethod
    def _apart(text: str) -> str:
        """What is encoded apart, between ASCII blanks: runs of marks and what lies between; all between blanks where an apostrophe touches another mark."""
        text = text.replace("\x85", " ").replace("\xa0", " ")
        return text if "'" in text and _BESIDE.search(text) else _MARKS.sub(r" \g<0> ", text)

    @staticmethod
    def _plain(text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(c in text for c in _ODD)

    def _learn(self, new: list[str]) -> None:
        memo, odd, together = self.memo, [], self.ends.any()
        plain = [w for w in new if w.isalpha()] if together else []
        lines = [plain[at : at + LINE_WORDS] for at in range(0, len(plain), LINE_WORDS)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cuts) == len(line):
                raw = ids.tobytes()
                memo.update((w, raw[a:b]) for w, a, b in zip(line, [0, *cuts], cuts, strict=False))
            else:
                odd += line
        odd += [w for w in new if not w.isalpha()] if together else new
        for w, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            memo[w] = array("I", e.ids).tobytes()


def _word_encoder(path: str) -> WordEncoder:
    """One for each worker process and file."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """Byte ``k`` (or bit ``k``) of every id of a block, for each ``k``."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [octets[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(parts: list[bytes], n: int) -> np.ndarray:
    """The ids of a block; four planes are bytes, thirty-two are bits."""
    if len(parts) == 4:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


def _encoded(encoder: WordEncoder, texts: pa.StringArray) -> Iterator[np.ndarray]:
    group, size = [], 0
    for text in texts:
        group.append(text.as_py())
        size += len(group[-1])
        if size > GROUP_CHARS:
            yield from encoder.encode_many(group)
            group, size = [], 0
    yield from encoder.encode_many(group)


def _encode_shards(path: str, end_id: int, block_ids: int, planes: str, level: int):
    schema = pa.schema([
        ("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()), ("plane_sizes", pa.list_(pa.int32())),
        ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_encoder(path)
        squeeze = zstandard.ZstdCompressor(level=level)
        shard, end = TaskContext.get().partitionId(), np.array([end_id], dtype="<u4")
        held: list[np.ndarray] = []
        n_held = first = chunk = position = 0
        docs: list[tuple] = []

        def cut(n: int) -> pa.RecordBatch:
            nonlocal held, n_held, first, chunk, docs
            ids = np.concatenate(held)
            block, rest = ids[:n], ids[n:]
            parts = [squeeze.compress(p) for p in to_planes(block, planes)]
            names, starts, lengths = zip(*docs, strict=True)
            row = [[shard], [chunk], [first], [n], [[len(p) for p in parts]], [b"".join(parts)], [list(names)], [list(starts)], [list(lengths)]]
            held, n_held, first, chunk = [rest], len(rest), first + n, chunk + 1
            docs = [d for d in docs if d[1] + d[2] > first]
            return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), _encoded(encoder, batch.column(1)), strict=True):
                held += [ids, end]
                docs.append((doc_id, position, len(ids) + 1))
                position += len(ids) + 1
                n_held += len(ids) + 1
                while n_held >= block_ids:
                    yield cut(block_ids)
        if n_held:
            yield cut(n_held)
        if len(encoder.memo) > KEPT_WORDS:  # the process goes on to other tasks
            encoder.memo = {}

    return run


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end_id: int = 1, block_ids: int = 65536, planes: str = "byte", level: int = 3) -> None:
    """Encode every whole text and write a token store, documents in ascending doc_id order.

    ``tokenizer`` is the path of a tokenizers file, ``planes`` is ``byte`` (4 planes) or ``bit`` (32).
    Null texts are empty and hold the end id alone; null doc_ids come first; repeated doc_ids are
    kept as rows of their own, ordered by text. An empty table gives an empty store. A task holds
    one block and one Arrow batch, whatever the shard's size. There are as many shards as the session has
    shuffle partitions, or as the texts' bytes ask for. Other columns of the table are ignored.
    """
    if planes not in ("byte", "bit"):
        raise ValueError(f"planes must be byte or bit, not {planes!r}")
    spark = docs.sparkSession
    texts = doc_texts(docs)
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-size // SHARD_BYTES))
    # The beginning of a text parts rows of one doc_id, and those without.
    ranged = texts.repartitionByRange(shards, "doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(_encode_shards(tokenizer, end_id, block_ids, planes, level), CHUNKS).write.parquet(f"{path}/chunks")
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    index = chunks.join(F.broadcast(_shard_bases(chunks)), "shard").select("shard", "chunk", (F.col("base") + F.col("first_id")).alias("first_id"), "n_ids", F.length("payload").alias("payload_bytes"))
    index.write.parquet(f"{path}/index")


def _shard_bases(chunks: DataFrame) -> DataFrame:
    """(shard, base): ids in all earlier shards. A row per shard, so as many as write tasks."""
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return sizes.selectExpr("shard", "coalesce(sum(n) over (order by shard rows between unbounded preceding and 1 preceding), 0) as base")


def _decode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "n_tokens", "crc", "part_at", "part"]
    for batch in batches:
        for row, ids in _blocks(batch.to_pylist()):
            first = row["first_id"]
            out: list[tuple] = []
            for doc_id, start, n in zip(row["doc_ids"], row["doc_starts"], row["doc_lengths"], strict=True):
                lo, hi = max(start, first), min(start + n, first + row["n_ids"])
                data = ids[lo - first : hi - first].tobytes()
                whole = hi - lo == n
                out.append((doc_id, row["base"] + start, n, zlib.crc32(data) if whole else None, None if whole else lo - start, None if whole else data))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from a store's blocks.

    Blocks are decoded independently; a document that crosses blocks is joined from its parts.
    """
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    based = chunks.join(F.broadcast(_shard_bases(chunks)), "shard")
    parts = based.mapInArrow(_decode_blocks, SEGMENTS)
    whole = F.aggregate(F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part_at", "part")))), F.lit(b""), lambda a, p: F.concat(a, p["part"]))
    return parts.groupBy("start", "doc_id", "n_tokens").agg(F.max("crc").alias("crc"), whole.alias("ids")).select("doc_id", "start", "n_tokens", F.coalesce("crc", F.crc32("ids")).alias("ids_crc32"))


def _blocks(rows: list[dict]) -> Iterator[tuple[dict, np.ndarray]]:
    expand = zstandard.ZstdDecompressor()
    for row in rows:
        at, parts = 0, []
        for size in row["plane_sizes"]:
            parts.append(expand.decompress(row["payload"][at : at + size]))
            at += size
        yield row, from_planes(parts, row["n_ids"])


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``at, ids``: the ids at positions ``start`` to ``stop`` of the whole store, in pieces, each with the position of its first id.

    The index tells which blocks hold them; only shards between the first and the last of these are read, and only those blocks are decoded.
    """
    if start < 0 or stop < start:
        raise ValueError(f"not a range of positions: {start} to {stop}")
    index = spark.read.parquet(f"{path}/index").where((F.col("first_id") < stop) & (F.col("first_id") + F.col("n_ids") > start))
    low, high = index.agg(F.min("shard"), F.max("shard")).first()
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").where(F.col("shard").between(-1 if low is None else low, -1 if high is None else high))
    wanted = chunks.drop("first_id").join(index.select("shard", "chunk", "first_id"), ["shard", "chunk"]).select("first_id", "n_ids", "plane_sizes", "payload")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, ids in _blocks(batch.to_pylist()):
                low, high = max(start, row["first_id"]), min(stop, row["first_id"] + row["n_ids"])
                part = ids[low - row["first_id"] : high - row["first_id"]].astype("int64")
                yield pa.RecordBatch.from_arrays([pa.array([low], pa.int64()), pa.array([part], pa.list_(pa.int64()))], names=["at", "ids"])

    return wanted.mapInArrow(pieces, "at long, ids array<long>")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` with the ids of every document as an array, for a consumer of the store."""
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    based = chunks.join(F.broadcast(_shard_bases(chunks)), "shard")

    def rows(batches):
        for batch in batches:
            for row, ids in _blocks(batch.to_pylist()):
                first = row["first_id"]
                for doc_id, start, n in zip(row["doc_ids"], row["doc_starts"], row["doc_lengths"], strict=True):
                    lo, hi = max(start, first), min(start + n, first + row["n_ids"])
                    piece = pa.array([ids[lo - first : hi - first].astype("int64")], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([row["base"] + start], pa.int64()), pa.array([lo], pa.int64()), piece], names=["doc_id", "start", "part_at", "part"])

    parts = based.mapInArrow(rows, "doc_id long, start long, part_at long, part array<long>")
    return parts.groupBy("doc_id", "start").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part_at", "part"))), lambda p: p["part"])).alias("ids"))
