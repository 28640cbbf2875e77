"""Training-order materialisation of token ids.

Texts become byte-pair token ids, end with one end token each, and are cut into sequences of
a fixed length (a text's last one is filled up), so a sequence never mixes two texts. A text
reserves as many numbers as it could have sequences (a token has a byte or more), which needs
no encoding to count. A keyed Feistel permutation of all reserved numbers, walked along its
cycles until it lands inside their count, gives every sequence its place without any sort of
the whole. Places are dealt in ranges to tasks and shard files, where each sequence takes the same number of
bytes and those not used take none; the shards' counts turn places into global slots without
holes. Training reads shards one after the other and can resume at any slot by a seek.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import compute
from pyarrow.dataset import dataset
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch, forget_at_exit, shared_dir
from inkwell.llm.scratch import store as open_store
from inkwell.llm.words import U64, mix, text_bytes

#: Tokens in a sequence, reserved places in a shard, rounds of the permutation, key.
LENGTH, SHARD_PLACES, ROUNDS, KEY = 512, 32_768, 6, 20_240_601
#: Shards that a task writes at most, and shards whose counts are summed at once.
TASK_SHARDS, SUMMED_SHARDS = 8, 1 << 16
TOKENIZER, END = "/opt/tokenizers/byte_bpe_50k.tiktoken", 50_256
#: Fixed value: the pre-tokenisation pattern of the public 50k byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TYPE = "<u2"


def feistel(x: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A permutation of 0..n-1, at each of ``x``. The network permutes the least even number of bits that holds n; results outside go round again."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = U64((1 << half) - 1)
    with np.errstate(over="ignore"):
        keys = mix(np.arange(ROUNDS, dtype=U64) + U64(key) * U64(2654435761))
    out, left = x.astype(U64), np.arange(len(x))
    while len(left):
        v = out[left]
        high, low = v >> U64(half), v & mask
        for k in keys:
            high, low = low, high ^ (mix(low ^ k) & mask)
        v = (high << U64(half)) | low
        out[left] = v
        left = left[v >= U64(n)]
    return out.astype(np.int64)


def load_ranks(path: str = TOKENIZER) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes):
    """tiktoken's encoder, one per process (its registry holds it)."""
    import tiktoken
    from tiktoken import registry

    name = f"inkwell-{zlib.crc32(ranks)}"
    if name not in registry.ENCODINGS:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        registry.ENCODINGS[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return registry.ENCODINGS[name]


#: Characters of a text that are encoded at once; a cut falls before a blank, where the pattern never joins what it parts.
PIECE = 1 << 16


def encode(enc, text: str) -> list[int]:
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    out, at = [], 0
    while at < len(text):
        to = at + PIECE
        # Between a letter or digit and a single blank that a letter follows, no match of the pattern reaches across.
        while to < len(text) and not (text[to] == " " and text[to - 1].isalpha() and text[to + 1 : to + 2].isalpha()):
            to += 1
        out += enc.encode_ordinary(text[at:to])
        at = to
    return out


#: Texts whose ids are kept for the next copies of them, and how long such a text may be.
RECENT, RECENT_CHARS = 1024, 8192


def remembering(enc):
    """``encode`` that knows the latest short texts: a large group of copies is encoded about once a task."""
    short = lru_cache(RECENT)(enc.encode_ordinary)
    return lambda text: short(text) if len(text) <= RECENT_CHARS else encode(enc, text)


def reserved(texts: pa.Array, length: int) -> np.ndarray:
    """The most sequences that each text and its end token can fill."""
    return np.diff(text_bytes(texts)[1]) // length + 1


def _count(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n, check = 0, 0
        for batch in batches:
            own = reserved(batch.column("text"), length)
            n, check = n + int(own.sum()), zlib.crc32(own.tobytes(), check)
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "n": [n], "sizes": [check]}, schema=pa.schema([("part", pa.int32()), ("n", pa.int64()), ("sizes", pa.int64())]))

    return run


PIECES = "place long, doc_id long, piece int, n_tokens int, tokens binary"
PIECES_ARROW = pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int32()), ("tokens", pa.binary())])


def _fixed(body: bytes, step: int) -> pa.Array:
    """A binary array of equal rows over one buffer."""
    n = len(body) // step
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, len(body) + 1, step, dtype=np.int32)), pa.py_buffer(body)])


def _place(ranks, parts, length: int, total: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, number = remembering(encoder(ranks.value)), TaskContext.get().partitionId()
        first, expected, sizes = parts.value[number]
        at, check = first, 0
        step = length * np.dtype(TYPE).itemsize
        filling = np.full(length, END, TYPE).tobytes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                doc, piece, size, bodies, numbers = [], [], [], [], []
                own = reserved(part.column("text"), length)
                check = zlib.crc32(own.tobytes(), check)
                for d, text, most in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), own.tolist(), strict=True):
                    t = ids(text)
                    n = len(t) // length + 1
                    raw = array("H", t).tobytes()  # TYPE, on the little-endian machines that this runs on
                    bodies += (raw, filling[: n * step - len(raw)])
                    doc += [d] * n
                    piece += range(n)
                    size += [length] * (n - 1) + [len(t) + 1 - (n - 1) * length]
                    numbers += range(at, at + n)
                    at += most
                places = feistel(np.array(numbers, np.int64), total, key)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(size, pa.int32()), _fixed(b"".join(bodies), step)], schema=PIECES_ARROW)
        if at - first != expected or check != sizes:
            raise RuntimeError(f"partition {number} changed between counting and placing: {at - first} numbers, {expected} before")

    return run


DIGEST = "shard long, row int, doc_id long, piece int, n_tokens int, crc32 long"
DIGEST_ARROW = pa.schema([("shard", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int32()), ("crc32", pa.int64())])


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(path: str, shard_places: int):
    """Rows in order of place to shard files. A file gets its name when it is whole, and a task that runs again writes the same bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = open_store(path)
        store.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        current, out, row = None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                store.move(f"{root}/.{shard_name(current)}.{attempt}", f"{root}/{shard_name(current)}")

        for batch in batches:
            place = batch.column("place").to_numpy()
            shard, (data, off) = place // shard_places, text_bytes(batch.column("tokens"))
            view, cut = memoryview(data), off.tolist()
            crc = [zlib.crc32(view[cut[i] : cut[i + 1]]) for i in range(len(place))]
            edge = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(place)] if len(place) else [0]
            rows = []
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                if (s := int(shard[i])) != current:
                    close()
                    current, row = s, 0
                    out = store.open_output_stream(f"{root}/.{shard_name(s)}.{attempt}")
                out.write(view[cut[i] : cut[j]])
                rows += range(row, row + j - i)
                row += j - i
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(rows, pa.int32()), batch.column("doc_id"), batch.column("piece"), batch.column("n_tokens"), pa.array(crc, pa.int64())], schema=DIGEST_ARROW)
        close()

    return run


def write_training_order(
    docs: DataFrame, path: str, tokenizer: str = TOKENIZER, length: int = LENGTH, shard_places: int = SHARD_PLACES, key: int = KEY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write every text's token sequences to shards under ``path`` in permuted order, and their manifest; the result's rows are the sequences as they were written.

    slot, shard, row (place in the shard), doc_id, piece (number within the text), n_tokens (without
    filling), crc32 (of the row's bytes). A null or empty text is its end token alone. Rows that repeat one
    another, or an id, or have none, each have their own sequences. An empty table writes an empty manifest.
    The table is read twice, to count bytes and to encode; it must give the same rows in the same
    partitions both times, as files do, and is checked for that.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(tokenizer))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = {r.part: r for r in rows.mapInArrow(_count(length), "part int, n long, sizes long").collect()}
    parts, total = {}, 0
    for number in sorted(counts):
        parts[number] = (total, counts[number].n, counts[number].sizes)
        total += counts[number].n
    placed = rows.mapInArrow(_place(ranks, spark.sparkContext.broadcast(parts), length, total, key), PIECES)
    shards = max(1, -(-total // shard_places))
    # Places are spread evenly, so a range of them is a task of even size, and no sample has to find the ranges.
    each = max(1, min(TASK_SHARDS, shards // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = placed.repartitionById(-(-shards // each), F.floor(F.col("place") / (shard_places * each)).cast("int")).sortWithinPartitions("place")
    with Scratch(spark, "shards") as scratch:
        written = scratch.result(dealt.mapInArrow(_write(path, shard_places), DIGEST), "rows")
        held = scratch.result(written.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.floor(F.col("shard") / SUMMED_SHARDS)), "held")
        sums = sorted((r.part, r.n) for r in held.groupBy("part").agg(F.sum("n").alias("n")).collect())
        before = np.concatenate([[0], np.cumsum([n for _, n in sums])]).astype(np.int64).tolist()
        starts = spark.createDataFrame([(part, before[i]) for i, (part, _) in enumerate(sums)], "part long, _before long")
        so_far = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        first = held.join(starts, "part").select("shard", (F.col("_before") + so_far).alias("first_slot"), "n")
        first.repartitionByRange("shard").sortWithinPartitions("shard").write.mode("overwrite").parquet(f"{path}/index")
        _manifest(path, {"length": length, "bytes_per_token": np.dtype(TYPE).itemsize, "sequences": before[-1], "shards": shards, "key": key})
        first = spark.read.schema("shard long, first_slot long, n long").parquet(f"{path}/index").drop("n")
        return written.join(first, "shard").select((F.col("first_slot") + F.col("row")).alias("slot"), *written.columns)


def _manifest(path: str, what: dict) -> None:
    store, root = open_store(path)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(what).encode())


def read_sequences(path: str, start: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, tokens) from slot ``start`` on, one shard after the other: one seek, then reads in sequence. Nothing where ``start`` is past the last slot or nothing was written."""
    store, root = open_store(path)
    with store.open_input_stream(f"{root}/manifest.json") as f:
        m = json.loads(f.read())
    stride = m["length"] * m["bytes_per_token"]
    index = dataset(f"{root}/index", filesystem=store, format="parquet").to_table(filter=compute.field("first_slot") + compute.field("n") > start) if m["sequences"] else pa.table({"shard": [], "first_slot": [], "n": []})
    for shard in index.sort_by("shard").to_pylist():
        begin, end = shard["first_slot"], shard["first_slot"] + shard["n"]
        with store.open_input_file(f"{root}/{shard_name(shard['shard'])}") as f:
            f.seek((max(start, begin) - begin) * stride)
            for slot in range(max(start, begin), end):
                yield slot, np.frombuffer(f.read(stride), TYPE)


def materialise(spark: SparkSession, docs: DataFrame, tag: str = "shards", **options) -> DataFrame:
    """``write_training_order`` into the shared folder."""
    path = f"{shared_dir(spark)}/inkwell-{tag}-{uuid.uuid4().hex}"
    forget_at_exit(spark, path)
    return write_training_order(docs, path, **options)
