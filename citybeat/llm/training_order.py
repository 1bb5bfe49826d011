"""Training-order materialisation by a keyed Feistel permutation.

Documents are tokenised and each task's stream (documents in row order, each
followed by the end id) is cut into records of ``seq_len`` ids, the last one of
a task padded.  A record's number is its place in its task plus the records of
the tasks before; the permutation maps numbers to slots of the training order.
It is a balanced Feistel network on the next even number of bits, and a slot
beyond the number of records walks the cycle until it falls inside, so the map
is one to one on exactly the records, without a table or a sort of all rows.

Shard ``s`` holds slots ``s * per_shard`` to ``(s + 1) * per_shard - 1`` as one
payload of fixed-stride records (little-endian, two bytes an id while the
vocabulary fits, else four).  Slots are dense, so ranges of shards are dealt to
tasks by their number, without sampled splitters.  A reader finds slot ``i`` in
shard ``i // per_shard`` at byte ``i % per_shard * stride``; ``read_from``
resumes at any slot and reads on in order.

Edge cases: null text is empty and gives its end id; an empty table gives no
shard; repeated rows are written each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citybeat.llm.common import map_rows, materialise
from citybeat.llm.word_bpe import word_encoder

ROUNDS = 6
#: Every document of a record in order: its id, the first of its ids that stand here, and how many.
DOCS = "docs array<struct<doc_id:long,start:long,length:int>>"
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser of the splitmix generator."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def feistel(x: np.ndarray, half: int, key: int) -> np.ndarray:
    """One pass of the network over numbers of ``2 * half`` bits."""
    mask = _U((1 << half) - 1)
    left, right = x >> _U(half), x & mask
    for r in range(ROUNDS):
        seed = _U((key + r * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        left, right = right, left ^ (_mix(right + _mix(np.array([seed]))[0]) & mask)
    return (left << _U(half)) | right


def slots(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of record numbers below ``n``: a permutation of 0 .. n - 1."""
    half = max(1, -(-max(1, int(n - 1).bit_length()) // 2))
    with np.errstate(over="ignore"):
        out = feistel(np.asarray(index, dtype=np.uint64), half, key)
        outside = np.flatnonzero(out >= _U(n))
        while len(outside):  # cycle-walking
            out[outside] = feistel(out[outside], half, key)
            outside = outside[out[outside] >= _U(n)]
    return out.astype(np.int64)


def _records(df: DataFrame, tokenizer_path: str, key: str, text: str, seq_len: int, end_id: int, pad_id: int, kind: str) -> DataFrame:
    """Fixed-length records of every task's stream."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def process(batches):
        encoder, part, local = word_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        held, owners, size = [], [], 0  # streams, (doc, start in doc, ids) of the open record

        def record(ids: np.ndarray, n: int) -> tuple:
            nonlocal local
            local += 1
            docs = [{"doc_id": k, "start": at, "length": size} for k, at, size in owners]
            return part, local - 1, *owners[0][:2], n, docs, ids.astype(kind).tobytes()

        names = ("part", "local", "doc_id", "start", "n_tokens", "docs", "payload")
        for batch in batches:
            rows = []
            for k, t in zip(batch[key], batch[text]):
                ids = np.frombuffer(encoder.encode(t or "") + end, dtype="<u4")
                at = 0
                while at < len(ids):
                    n = min(seq_len - size, len(ids) - at)
                    owners.append((k, at, n))
                    held.append(ids[at : at + n])
                    size, at = size + n, at + n
                    if size == seq_len:
                        rows.append(record(np.concatenate(held), seq_len))
                        held, owners, size = [], [], 0
            yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}
        if size:
            ids = np.concatenate([*held, np.full(seq_len - size, pad_id, dtype="<u4")])
            yield dict(zip(names, ([x] for x in record(ids, size))))

    schema = f"part long, local long, doc_id long, start long, n_tokens int, {DOCS}, payload binary"
    return map_rows(df, [key, text], process, schema)


def write_shards(
    df: DataFrame,
    tokenizer_path: str,
    order_key: int = 20240229,
    key: str = "doc_id",
    text: str = "text",
    seq_len: int = 2048,
    per_shard: int = 512,
    end_id: int = 1,
    pad_id: int = 0,
    vocabulary: int = 49408,
) -> DataFrame:
    """Shards in the shared folder: shard, first_slot, n_records, stride, payload and per record its number,
    first document, start in it, real tokens and all documents with start and length (arrays in slot order)."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    stride = seq_len * int(kind[2])
    records = materialise(_records(df, tokenizer_path, key, text, seq_len, end_id, pad_id, kind), "order-records", "zstd")
    # one row per task of the tokenising stage
    counts = records.groupBy("part").count().orderBy("part").collect()
    before, total = {}, 0
    for row in counts:
        before[row.part] = total
        total += row["count"]

    @F.pandas_udf("long")
    def slot_of(number: pd.Series) -> pd.Series:
        return pd.Series(slots(number.to_numpy(), total, order_key))

    spark = df.sparkSession
    offsets = spark.createDataFrame(sorted(before.items()), "part long, before long")
    numbered = records.join(F.broadcast(offsets), "part").withColumn("number", F.col("before") + F.col("local"))
    placed = numbered.withColumn("slot", slot_of("number")).withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-total // per_shard))
    ranged = placed.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("slot")

    def process(batches):
        now, rows = None, []

        def flush() -> dict[str, list]:
            number, doc, start, n, docs, payload = zip(*rows)
            return {
                "shard": [now],
                "first_slot": [now * per_shard],
                "n_records": [len(rows)],
                "stride": [stride],
                "payload": [b"".join(payload)],
                "number": [list(number)],
                "doc_id": [list(doc)],
                "start": [list(start)],
                "n_tokens": [list(n)],
                "docs": [list(docs)],
            }

        for batch in batches:
            for shard, *row in zip(*(batch[c] for c in columns)):
                if shard != now:
                    if rows:
                        yield flush()
                    now, rows = shard, []
                rows.append(row)
        if rows:
            yield flush()

    columns = ["shard", "number", "doc_id", "start", "n_tokens", "docs", "payload"]
    schema = (
        "shard long, first_slot long, n_records int, stride int, payload binary, number array<long>, "
        "doc_id array<long>, start array<long>, n_tokens array<int>, "
        "docs array<array<struct<doc_id:long,start:long,length:int>>>"
    )
    return materialise(map_rows(ranged, columns, process, schema), "order-shards", "zstd")


def read_from(shards: DataFrame, slot: int = 0, slots_wanted: int | None = None) -> DataFrame:
    """Records from ``slot`` on: slot, shard, byte_offset, number, doc_id, start, n_tokens, docs, ids (bytes).

    Only the shards that hold the slots are read.
    """
    last = None if slots_wanted is None else slot + slots_wanted
    picked = shards.filter(F.col("first_slot") + F.col("n_records") > slot)
    if last is not None:
        picked = picked.filter(F.col("first_slot") < last)
    each = picked.select(
        "shard", "first_slot", "stride", "payload", "number", "doc_id", "start", "n_tokens", "docs",
        F.explode(F.sequence(F.lit(0), F.col("n_records") - 1)).alias("i"),
    ).withColumn("slot", F.col("first_slot") + F.col("i"))
    each = each.filter(F.col("slot") >= slot) if last is None else each.filter(F.col("slot").between(slot, last - 1))
    byte = (F.col("i") * F.col("stride")).alias("byte_offset")
    pick = [F.get(c, F.col("i")).alias(c) for c in ("number", "doc_id", "start", "n_tokens", "docs")]
    return each.select("slot", "shard", byte, *pick, F.substring("payload", F.col("i") * F.col("stride") + 1, F.col("stride")).alias("ids"))
