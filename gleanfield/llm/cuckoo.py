"""Exact deduplication over a cuckoo-filter index of content digests."""

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import ascii_lower, stored

SLOTS = 4
FULL_KICKS = 200


class CuckooIndex:
    """Live keys behind a cuckoo filter.

    The filter holds a 16-bit mark per key in one of two buckets of `SLOTS`;
    beside each mark lies the key's content, so a hit is verified against the
    bucket it was found in. Keys can be inserted and deleted. When an insertion
    finds no place after `FULL_KICKS` moves, the table doubles and is filled
    again from the stored keys.

    Keys are byte strings of evenly spread bytes (digests), at least 12 long.
    """

    def __init__(self, buckets: int = 16):
        self.size = 0
        self.resized = 0
        self._clear(buckets)

    def _clear(self, buckets: int):
        self.mask = buckets - 1
        self.marks: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[list[tuple[bytes, object]]] = [[] for _ in range(buckets)]

    def _mark(self, key: bytes) -> int:
        return int.from_bytes(key[:2], "little") or 1

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = self._mark(key)
        first = int.from_bytes(key[2:10], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & self.mask)

    def _find(self, key: bytes) -> tuple[int, int] | None:
        mark, a, b = self._places(key)
        for bucket in (a, b):
            marks = self.marks[bucket]
            if mark in marks:
                for slot, (stored, _) in enumerate(self.content[bucket]):
                    if marks[slot] == mark and stored == key:
                        return bucket, slot
        return None

    def get(self, key: bytes, default=None):
        at = self._find(key)
        return default if at is None else self.content[at[0]][at[1]][1]

    def __contains__(self, key: bytes) -> bool:
        return self._find(key) is not None

    def __len__(self) -> int:
        return self.size

    def delete(self, key: bytes) -> bool:
        at = self._find(key)
        if at is None:
            return False
        bucket, slot = at
        del self.marks[bucket][slot], self.content[bucket][slot]
        self.size -= 1
        return True

    def insert(self, key: bytes, value) -> None:
        """Add `key`, or give it a new value."""
        at = self._find(key)
        if at is not None:
            self.content[at[0]][at[1]] = (key, value)
            return
        self.size += 1
        homeless = self._place(key, value)
        if homeless is not None:
            self._grow(homeless)

    def _grow(self, homeless: tuple[bytes, object]) -> None:
        kept = [homeless, *self.items()]
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.resized += 1
            self._clear(buckets)
            if all(self._place(key, value) is None for key, value in kept):
                return

    def _place(self, key: bytes, value) -> tuple[bytes, object] | None:
        """Put the entry into one of its buckets; the entry left without a place, if any."""
        mark, a, b = self._places(key)
        for bucket in (a, b):
            if len(self.marks[bucket]) < SLOTS:
                self.marks[bucket].append(mark)
                self.content[bucket].append((key, value))
                return None
        bucket, entry = b, (key, value)
        for kick in range(FULL_KICKS):
            slot = kick % SLOTS
            mark, self.marks[bucket][slot] = self.marks[bucket][slot], mark
            entry, self.content[bucket][slot] = self.content[bucket][slot], entry
            bucket = self._other(bucket, mark)
            if len(self.marks[bucket]) < SLOTS:
                self.marks[bucket].append(mark)
                self.content[bucket].append(entry)
                return None
        return entry

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self.content:
            yield from bucket


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of each text after lower-casing A-Z; null counts as empty."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def groups(found: DataFrame, rows_per_index: int = 200_000) -> DataFrame:
    """text_sha256, keep_id and group_size per digest of `found` (doc_id, text_sha256).

    Copies are first reduced to one row per digest and task. Those rows go to
    one index per range of digests, about `rows_per_index` in each, so a group of any
    size is a row per task at most. In an index a later id
    supersedes an earlier one: the digest's entry is deleted and inserted anew.
    """
    spark = found.sparkSession
    indexes = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), found.count() // rows_per_index + 1
    )

    def reduce(batches):
        held: dict[str, tuple[int | None, int]] = {}
        for batch in batches:
            for doc_id, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                old = held.get(digest)
                held[digest] = (doc_id, 1) if old is None else (later(old[0], doc_id), old[1] + 1)
            if len(held) > rows_per_index:
                yield batch_of(held)
                held = {}
        if held:
            yield batch_of(held)

    def batch_of(held):
        ids, counts = zip(*held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held)), pa.array(ids, pa.int64()), pa.array(counts, pa.int64())],
            names=["text_sha256", "doc_id", "n"],
        )

    def index(_, rows: pd.DataFrame) -> pd.DataFrame:
        live = CuckooIndex()
        ids = rows["doc_id"].astype("Int64")
        for digest, doc_id, n in zip(rows["text_sha256"], ids, rows["n"]):
            doc_id = None if doc_id is pd.NA else int(doc_id)
            key = bytes.fromhex(digest)
            old = live.get(key)
            if old is None:
                live.insert(key, (doc_id, int(n)))
                continue
            if later(old[0], doc_id) != old[0]:  # superseded: the old entry goes
                live.delete(key)
            live.insert(key, (later(old[0], doc_id), old[1] + int(n)))
        entries = list(live.items())
        return pd.DataFrame(
            {
                "text_sha256": [k.hex() for k, _ in entries],
                "keep_id": pd.array([v[0] for _, v in entries], "Int64"),
                "group_size": [v[1] for _, v in entries],
            }
        )

    reduced = found.select("doc_id", "text_sha256").mapInArrow(
        reduce, "text_sha256 string, doc_id long, n long"
    )
    bucket = F.conv(F.substring("text_sha256", 57, 8), 16, 10).cast("long") % indexes
    return reduced.groupBy(bucket.alias("bucket")).applyInPandas(
        index, "text_sha256 string, keep_id long, group_size long"
    )


def later(a: int | None, b: int | None) -> int | None:
    return b if a is None or b is not None and b > a else a


def dedup_exact(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): keep_id, group_size, kept, text_sha256.

    Of texts that are equal after lower-casing A-Z the row with the largest
    doc_id stays. A null text counts as empty. A null doc_id is smaller than any
    other. Repeated rows with the id that stays are all marked kept; `drop_copies`
    leaves one of them. An empty table gives no rows; further columns are not
    looked at.
    """
    found = stored(digests(docs))
    return found.join(groups(found), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """`docs` without copies, all columns as they were; one row per distinct text.

    The row with the largest doc_id stays; of rows that repeat that id and text
    one stays, picked by a hash over its columns.
    """
    columns = docs.columns
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        row_key(F.sha2(text.cast("binary"), 256), F.col("doc_id").cast("long")).alias("key"),
    )
    keep = groups(stored(digests(docs))).select(
        row_key(F.col("text_sha256"), F.col("keep_id")).alias("key"), (F.col("group_size") > 1).alias("copied")
    )
    held = keyed.join(stored(keep), "key")
    # repeated rows of one id are reduced in two steps, so that none of them meets all others in a task
    repeated = held.where("copied").withColumn("salt", F.monotonically_increasing_id() % 64)
    for by in (["key", "salt"], ["key"]):
        repeated = repeated.groupBy(*by).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    rows = held.where("not copied").select("row").unionByName(repeated.select("row"))
    return rows.select(*[F.col(f"row.`{c}`") for c in columns])


def row_key(digest: Column, doc_id: Column) -> Column:
    return F.concat_ws("/", digest, doc_id.cast("string"))
