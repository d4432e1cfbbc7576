"""Token ids in training order, as fixed-stride binary shards.

Texts are tokenised once and stored. Read in stored order, each followed by
an end mark, their tokens are one stream, cut into sequences of
``length`` tokens (the last one filled up with end marks). A keyed Feistel
permutation with cycle-walking over exactly the number of sequences gives
every sequence its global slot: a bijection that needs no table, so any
sequence's slot, and any slot's sequence, is computed on the spot. Ranges of
slots are shards; a shard holds ``rows`` sequences of ``length * 2`` bytes
(16-bit little-endian ids), so that slot s starts at byte
``(s % rows) * length * 2`` of shard ``s // rows``: reads are sequential, and
resume at any slot.

Only sequences, whole but where they lie across tasks, are cut and shuffled once, packed, by ranges of whole shards, so
that the files are written without another shuffle; documents of any length
are cut over their sequences. The driver sees one token count
a partition. Null and empty texts contribute their end mark, and every
input row is in the stream once, repeated ids included.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, stored
from pylonflow.llm.decontaminate import _slices
from pylonflow.session import scratch_path, ship_package

END_OF_TEXT = 50_256     # free in the default vocabulary of 50,256 ids
LENGTH = 1024
ROWS = 4096
KEY = 0x5DEECE66D
SAMPLES = 4000           # beginnings of texts, of a sequence's size at most, that the dictionary for packing pieces is made of
# the token table is as long as the corpus: pages wide enough for zstd to find copies of texts
PACKED = {"parquet.compression.codec.zstd.level": "5", "parquet.page.size": str(8 << 20)}
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _round(x: np.ndarray, key: int, k: int) -> np.ndarray:
    x = x + np.uint64((key + (k + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _M[1]
    x = (x ^ (x >> np.uint64(27))) * _M[2]
    return x ^ (x >> np.uint64(31))


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _feistel(x: np.ndarray, n: int, key: int, rounds: range) -> np.ndarray:
    """One pass over the domain of 2 ** (2 * half bits) numbers; rounds in reverse order undo it."""
    bits = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    left, right = x >> bits, x & mask
    if rounds.step > 0:
        for k in rounds:
            left, right = right, left ^ (_round(right, key, k) & mask)
    else:
        for k in rounds:
            left, right = right ^ (_round(left, key, k) & mask), left
    return (left << bits) | right


def permute(x: np.ndarray, n: int, key: int = KEY, inverse: bool = False, rounds: int = 6) -> np.ndarray:
    """The bijection of 0 .. n-1 (or its inverse): numbers that leave the range walk on until they are back."""
    order = range(rounds - 1, -1, -1) if inverse else range(rounds)
    out = _feistel(np.asarray(x, np.uint64), n, key, order)
    while len(away := np.flatnonzero(out >= np.uint64(n))):
        out[away] = _feistel(out[away], n, key, order)
    return out.astype(np.int64)


def default_ranks() -> tuple[str, str]:
    """Path of the default vocabulary's rank file and its splitting pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str):
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def tokenise(df: DataFrame, key: str = "doc_id", text: str = "text", ranks_path: str | None = None,
             pattern: str | None = None, end: int = END_OF_TEXT) -> DataFrame:
    """Stored (part, at, key, n, tokens): each text's ids with the end mark, 16 bits each, and its place in the
    part's own stream. Parts are the tasks that read the table."""
    if ranks_path is None or pattern is None:
        ranks_path, pattern = default_ranks()
    with open(ranks_path, "rb") as f:   # the driver's copy of the vocabulary, under a MB, goes to the tasks
        ranks = f.read()
    spark = df.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = _encoder(sent.value, pattern), TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, hi in _slices(b.column(1), 4 << 20):
                texts = pc.fill_null(b.column(1).slice(lo, hi - lo), "").to_pylist()
                ids = [np.array([*enc.encode_ordinary(t), end], np.uint16) for t in texts]    # no ids are special
                sizes = np.array([len(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), pa.array(at + np.cumsum(sizes) - sizes),
                     b.column(0).slice(lo, hi - lo), pa.array(sizes), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["part", "at", "key", "n", "tokens"])
                at += int(sizes.sum())

    return stored(df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(
        encode, "part int, at long, key string, n long, tokens binary"), "tokens", **PACKED)


def _cut(row_at: int, tokens: bytes, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(sequence, place in it, bytes) of a text's ids from stream position ``row_at`` on."""
    done, n = 0, len(tokens) // 2
    while done < n:
        k, place = divmod(row_at + done, length)
        take = min(length - place, n - done)
        yield k, place, tokens[2 * done: 2 * (done + take)]
        done += take


def _dictionary(tokens: DataFrame, length: int) -> bytes:
    """What pieces of token ids have in common, of a bounded sample (32 KB); it changes their packed size, nothing else."""
    sample = [bytes(r["x"]) for r in tokens.select(F.expr(f"substring(tokens, 1, {2 * length})").alias("x")).limit(SAMPLES).collect()]
    try:
        return zstandard.train_dictionary(1 << 15, sample).as_bytes() if len(sample) >= 100 else b""
    except zstandard.ZstdError:     # too little, or all alike
        return b""


def training_order(tokens: DataFrame, length: int = LENGTH, rows: int = ROWS, seed: int = KEY,
                   end: int = END_OF_TEXT) -> DataFrame:
    """(slot, shard, byte_offset, sequence, keys, tokens): every sequence once, sorted by slot in its partition,
    every shard whole in one partition."""
    spark = tokens.sparkSession
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).collect()   # one row a partition of the input
    bases, total = {}, 0
    for p, n in sorted((r["part"], r["n"]) for r in totals):
        bases[p], total = total, total + n
    count = -(-total // length)
    common = _dictionary(tokens, length)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(common) if common else None).compress
        now, first, size, blobs, owners, rows = None, 0, 0, [], [], []     # the stretch of a sequence being put together

        def out():
            k = np.array([r[0] for r in rows], np.int64)
            columns = [pa.array(permute(k, count, seed)), pa.array(k), pa.array([r[1] for r in rows], pa.int32()),
                       pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([r[3] for r in rows], pa.binary())]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["slot", "sequence", "place", "keys", "ids"])

        for b in batches:
            for part, at, key, ids in zip(*[b.column(c).to_pylist() for c in range(4)], strict=True):
                for k, place, blob in _cut(bases[part] + at, ids, length):
                    if now is not None and (k != now or place != first + size):
                        rows.append((now, first, owners, pack(b"".join(blobs))))
                        now = None
                    if now is None:
                        now, first, size, blobs, owners = k, place, 0, [], []
                    blobs.append(blob), owners.append(key)
                    size += len(blob) // 2
                    if len(rows) >= 2048:
                        yield out()
        if now is not None:
            rows.append((now, first, owners, pack(b"".join(blobs))))
        if rows:
            yield out()

    fill = np.full(length, end, np.uint16).tobytes()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blob, owners = None, [], []   # the sequence being put together
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(common) if common else None).decompress

        def close():
            whole = b"".join(blob)
            return now[0], now[0] // rows, (now[0] % rows) * length * 2, now[1], list(dict.fromkeys(owners)), whole + fill[len(whole):]

        def out(done):
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

        names = ["slot", "shard", "byte_offset", "sequence", "keys", "tokens"]
        for b in batches:
            done = []
            for slot, k, keys, ids in zip(*[b.column(c).to_pylist() for c in (0, 1, 3, 4)], strict=True):
                if now is None or now[0] != slot:
                    if now is not None:
                        done.append(close())
                    now, blob, owners = (slot, k), [], []
                blob.append(unpack(ids))
                owners += keys
                if len(done) >= 4096:
                    yield out(done)
                    done = []
            if done:
                yield out(done)
        if now is not None:
            yield out([close()])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = tokens.select("part", "at", "key", "tokens").mapInArrow(
        pieces, "slot long, sequence long, place int, keys array<string>, ids binary")
    # slots are dense, so the ranges are known: nothing is cut twice to sample them; AQE leaves a given number alone
    shards = max(1, -(-count // rows))
    owner = F.floor(F.floor(F.col("slot") / F.lit(rows)) * F.lit(n) / F.lit(shards)).cast("int")
    return (cut.repartitionById(n, owner).sortWithinPartitions("slot", "place")
            .mapInArrow(join, "slot long, shard long, byte_offset long, sequence long, keys array<string>, tokens binary"))


def _shard_folder(uri: str) -> str:
    """``uri`` as pyarrow names it: Hadoop's s3a is its s3."""
    return "s3" + uri[3:] if uri.startswith("s3a:") else uri


def _written(sequences: DataFrame, uri: str) -> DataFrame:
    """Write one file a shard and return, stored, a row a sequence (slot, shard, byte_offset, sequence, keys) and a row
    a shard (shard, file, first_slot, rows, bytes, crc32; null slot). Every shard must be whole in one partition and
    sorted by slot."""
    uri = _shard_folder(uri)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        attempt, now, sink = TaskContext.get().taskAttemptId(), None, None
        shards = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("first_slot", pa.int64()), ("rows", pa.int64()),
                            ("bytes", pa.int64()), ("crc32", pa.int64())])
        whole = pa.schema([("slot", pa.int64()), ("byte_offset", pa.int64()), ("sequence", pa.int64()),
                           ("keys", pa.list_(pa.string())), *shards])

        def close():
            sink.close()
            store.move(f"{root}/.shard-{now['shard']:06d}-{attempt}", f"{root}/{now['file']}")
            done.append(now)

        for b in batches:
            done, none = [], pa.nulls(b.num_rows)
            for shard, slot, ids in zip(*[b.column(c).to_pylist() for c in range(3)], strict=True):
                if now is None or now["shard"] != shard:
                    if now is not None:
                        close()
                    now = {"shard": shard, "file": f"shard-{shard:06d}.bin", "first_slot": slot, "rows": 0, "bytes": 0, "crc32": 0}
                    sink = store.open_output_stream(f"{root}/.shard-{shard:06d}-{attempt}")
                sink.write(ids)
                now["rows"] += 1
                now["bytes"] += len(ids)
                now["crc32"] = zlib.crc32(ids, now["crc32"])
            columns = [b.column(1), *[b.column(c) for c in (3, 4, 5)], b.column(0), *[none.cast(f.type) for f in list(shards)[1:]]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, whole, strict=True)], schema=whole)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=whole)
        if now is not None:
            done = []
            close()
            yield pa.RecordBatch.from_pylist(done, schema=whole)

    return stored(sequences.select("shard", "slot", "tokens", "byte_offset", "sequence", "keys").mapInArrow(
        write, "slot long, byte_offset long, sequence long, keys array<string>, shard long, file string, first_slot long, "
               "rows long, bytes long, crc32 long"), "manifest")


def write_shards(sequences: DataFrame, uri: str, rows: int = ROWS, dealt: bool = False) -> DataFrame:
    """Write one file a shard under ``uri`` (any file system that pyarrow opens) and return the manifest
    (shard, file, first_slot, rows, bytes, crc32).

    A shard is one task's sorted stream; it is written under a name of the
    attempt's own and renamed when whole, so a lost or repeated task leaves
    no half shard. Shards already there are rewritten alike. ``dealt`` says
    that ``sequences`` comes straight from ``training_order`` with the same
    ``rows``; it is not shuffled again then.
    """
    spark = sequences.sparkSession
    ship_package(spark)
    if not dealt:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sequences = sequences.repartitionByRange(n, "shard").sortWithinPartitions("shard", "slot")
    return _written(sequences, uri).where("slot IS NULL").select("shard", "file", "first_slot", "rows", "bytes", "crc32")


def read_slots(slots: DataFrame, uri: str, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """``slots`` (any frame with ``slot``) with ``tokens`` from the shards under ``uri``, each read at its place."""
    ship_package(slots.sparkSession)
    uri, at, stride = _shard_folder(uri), slots.columns.index("slot"), length * 2

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(uri)
        shard, source = None, None
        try:
            for b in batches:
                for lo in range(0, b.num_rows, 1024):
                    part, out = b.slice(lo, 1024), []
                    for slot in part.column(at).to_pylist():
                        if shard != slot // rows:
                            if source is not None:
                                source.close()
                            shard = slot // rows
                            source = store.open_input_file(f"{root}/shard-{shard:06d}.bin")
                        out.append(source.read_at(stride, slot % rows * stride))
                        if len(out[-1]) != stride:
                            raise ValueError(f"shard {shard} ends before slot {slot}")
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, "tokens"])
        finally:
            if source is not None:
                source.close()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slots.schema.fields]
    return slots.mapInArrow(read, ", ".join([*fields, "tokens binary"]))


def read_shards(manifest: DataFrame, uri: str, first_slot: int = 0, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """(slot, tokens) of all sequences from ``first_slot`` on, in order of slot: training goes on where it stopped."""
    total = manifest.agg(F.sum("rows")).first()[0] or 0
    return read_slots(manifest.sparkSession.range(min(first_slot, total), total).select(F.col("id").alias("slot")), uri, length, rows)


def op9_training_order(spark, sf_dir: str) -> DataFrame:
    """All sequences of ``documents`` with their slots, written into shards and read back from them."""
    uri = scratch_path(spark, "llm", "shards")
    ship_package(spark)
    index = _written(training_order(tokenise(documents(spark, sf_dir))), uri).where("slot IS NOT NULL")
    return read_slots(index.select("slot", "shard", "byte_offset", "sequence", "keys"), uri)
