"""Token shards in training order.

Documents become token sequences of fixed length. A keyed Feistel permutation gives every sequence
a slot of its own among 0..n-1: a network on the next even number of bits, walked along its cycle
until the value is below n. Ranges of slots are shards: files of equal records, so that the record
of any slot is found by arithmetic and reading resumes at any slot.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import bound, collect, small_batches, stored
from millrace.llm.hashing import text_bytes
from millrace.operators.numbering import number_stored_rows
from millrace.settings import scratch

LENGTH, PER_SHARD, ROUNDS = 512, 8192, 6
# In how many rounds the shards are written, each of which reads the sequences.
PASSES = 4
END = 50256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The published splitting pattern of the byte-level vocabulary.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")


@lru_cache(maxsize=2)
def batch_tokenizer(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encodes an array of texts with the byte-pair ranks at `path`: all ids, and the bounds of each
    text's.

    A blank between two other characters always begins a token, so a text can be cut there without
    changing its tokens. The distinct words of the array are encoded in one run, told apart by the
    bytes of the ids, and the texts' ids are gathered from the words'. Texts with other runs of blanks
    are encoded as a whole.
    """
    import tiktoken
    with fs.LocalFileSystem().open_input_stream(path) as f:
        lines = f.read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
    encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    if max(ranks.values()) >= 1 << 16:
        raise ValueError("ids are stored in 16 bits")
    width = np.zeros(max(ranks.values()) + 1, np.int64)
    width[list(ranks.values())] = [len(x) for x in ranks]

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.split_pattern(texts, " ")
        first = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # Empty, or with blanks of their own at an end.
        lone = pc.not_equal(pc.utf8_trim_whitespace(words), words).to_numpy(zero_copy_only=False)
        lone |= pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        odd = np.add.reduceat(lone[at].astype(np.int64), first[:-1]) > 0
        nothing, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        spaced = pc.binary_join_element_wise(nothing, words.filter(pa.array(~lone)), blank)
        bytes_ = np.where(lone, 0, pc.binary_length(words).to_numpy() + 1)
        joined = spaced.buffers()[2].to_pybytes()[:bytes_.sum()].decode() if len(spaced) else ""
        flat = encode.encode_to_numpy(joined, disallowed_special=()).astype(np.int64)
        cuts = np.searchsorted(np.cumsum(width[flat]), np.cumsum(bytes_), side="right")
        sizes = np.diff(cuts, prepend=0)
        # A text's first word has no blank before it; that of an odd text stands for all of it.
        heads = [encode.encode_ordinary(x.as_py()) for x in (
            texts[i] if whole else words[at[first[i]]] for i, whole in enumerate(odd))]
        at[first[:-1]] = len(words) + np.arange(len(odd))
        flat = np.concatenate([flat, np.array([i for x in heads for i in x], np.int64)])
        sizes = np.concatenate([sizes, np.array([len(x) for x in heads], np.int64)])
        counts = np.where(np.repeat(odd, np.diff(first)), 0, sizes[at])
        counts[first[:-1]] = sizes[len(words):]
        ends = np.cumsum(counts)
        begins = (np.cumsum(sizes) - sizes)[at]
        out = flat[np.repeat(begins - (ends - counts), counts) + np.arange(counts.sum())]
        return out, np.concatenate([[0], ends])[first]
    return run


def tokenizer(path: str) -> Callable[[str], list[int]]:
    """Encodes one text as `batch_tokenizer` does."""
    encode = batch_tokenizer(path)
    return lambda text: encode(pa.array([text], pa.large_string()))[0].tolist()


def _cut(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = batch_tokenizer(path)
        for batch in batches:
            for row, text, bounds in text_bytes(batch.column(1)):
                doc, order, size, data = [], [], [], []
                ids, at = encode(pa.LargeStringArray.from_buffers(
                    len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(text)))
                for i in range(len(bounds) - 1):
                    own = np.append(ids[at[i]:at[i + 1]], END).astype("<u2")
                    for j, s in enumerate(range(0, len(own), length)):
                        part = own[s:s + length]
                        doc.append(row + i)
                        order.append(j)
                        size.append(len(part))
                        data.append(part.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(order, pa.int32()),
                     pa.array(size, pa.int32()), pa.array(data, pa.binary())],
                    names=["doc_id", "sequence", "tokens", "data"])
    return run


def feistel(index: Column, n: int, key: int, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0..n-1, applied to `index`."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = F.lit((1 << half) - 1).cast("long")

    def once(x: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            mixed = F.xxhash64(F.lit(key), i, state["r"]).bitwiseAND(mask)
            return F.struct(state["r"].alias("l"), state["l"].bitwiseXOR(mixed).alias("r"))
        start = F.struct(F.shiftright(x, half).alias("l"), x.bitwiseAND(mask).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step,
                           lambda s: F.shiftleft(s["l"], half).bitwiseOR(s["r"]))
    def walk(x: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x,
                           lambda at, _: F.when(at >= n, once(at)).otherwise(at))
    # The network has fewer than 4 n values, so a step leaves n or more with odds below 3/4: a
    # first short walk serves nearly all rows, a long one (odds of 10^-120 to fail) the others.
    first = walk(once(index.cast("long")), 8)
    return bound(first, lambda x: F.when(x >= n, walk(x, 1000)).otherwise(x))


def _write(root: str, length: int, per_shard: int):
    """Writes each shard of a task whose rows are sorted by slot. A file appears under its name
    when it is whole, so a repeated or killed task does no harm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        files, base = fs.FileSystem.from_uri(root)
        pad = END.to_bytes(2, "little")
        rows = ((s, d) for b in batches for s, d in zip(
            b.column("slot").to_pylist(), b.column("data").to_pylist(), strict=True))
        for shard, group in itertools.groupby(rows, lambda r: r[0] // per_shard):
            part = f"{base}/.{shard:08d}-{TaskContext.get().taskAttemptId()}"
            n = 0
            with files.open_output_stream(part) as out:
                for _, data in group:
                    out.write(data + pad * (length - len(data) // 2))
                    n += 1
            files.move(part, f"{base}/{shard:08d}.u16")
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int64()), "records": pa.array([n], pa.int64())})
    return run


def training_order(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH,
                   key: int = 2024) -> DataFrame:
    """Stored: doc_id, sequence, tokens, data (16-bit little-endian ids), slot.

    A row for every sequence: each text, encoded as a whole and ended by the end id, is cut into
    runs of `length`. A null or empty text is one sequence, the end id. slot is a permutation of
    0..n-1 given by `key`. Repeated rows are sequences of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch(spark, "sequences")
    kind = docs.schema["doc_id"].dataType.simpleString()
    with small_batches(spark):
        docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
            _cut(vocabulary, length),
            f"doc_id {kind}, sequence int, tokens int, data binary").write.option(
            "compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    n = rows.count()
    return number_stored_rows(rows).withColumn(
        "slot", feistel(F.col("ROW_ID") - 1, n, key)).drop("ROW_ID")


def write_shards(ordered: DataFrame, folder: str, length: int = LENGTH,
                 per_shard: int = PER_SHARD) -> DataFrame:
    """Writes `ordered` (slot, data) as files of equal records, padded with the end id.

    Slot s is record s % per_shard of file s // per_shard, at byte 2 * length * (s % per_shard).
    The shards are written in PASSES rounds, so that only a part of the tokens lies in a shuffle at a
    time. Returns shard and records of each file. `folder` is a path or URI all executors can write to.
    """
    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    spark = ordered.sparkSession
    shard = F.floor(F.col("slot") / per_shard)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, rounds = ordered.select("slot", "data", shard.alias("shard")), []
    for i in range(PASSES):
        rounds.append(stored(rows.where(F.col("shard") % PASSES == i).repartition(n, "shard")
                             .sortWithinPartitions("slot").select("slot", "data").mapInArrow(
            _write(folder, length, per_shard), "shard long, records long"), "shards"))
        collect(spark)
    return reduce(DataFrame.union, rounds)


def read_slots(folder: str, first: int, count: int, length: int = LENGTH,
               per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """The ids of the slots from `first` on, read in order from where they lie."""
    files, base = fs.FileSystem.from_uri(folder)
    slot = first
    while slot < first + count:
        shard, at = divmod(slot, per_shard)
        with files.open_input_file(f"{base}/{shard:08d}.u16") as f:
            f.seek(2 * length * at)
            take = min(per_shard - at, first + count - slot)
            data = np.frombuffer(f.read(2 * length * take), "<u2").reshape(-1, length)
        if not len(data):
            return
        yield from data
        slot += len(data)


def materialise(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY,
                length: int = LENGTH, per_shard: int = PER_SHARD, key: int = 2024) -> DataFrame:
    """Writes the shards and returns where each sequence lies: doc_id, sequence, tokens, slot,
    shard, byte_offset."""
    folder = folder or scratch(docs.sparkSession, "training-shards")
    ordered = training_order(docs, vocabulary, length, key)
    written = write_shards(ordered, folder, length, per_shard)
    places = ordered.select(
        "doc_id", "sequence", "tokens", "slot", F.floor(F.col("slot") / per_shard).alias("shard"),
        (F.col("slot") % per_shard * (2 * length)).alias("byte_offset"))
    return places.join(written.select("shard", "records"), "shard")
