"""What the text operators share: batches, chunking, bounded caches, shared hashes.

Arrow batches go through Python in small slices, so a worker's memory follows
the longest single text rather than the partition.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import ship

#: Texts in a slice, and characters after which a slice ends early.
SLICE_ROWS, SLICE_CHARS = 512, 4_000_000
#: Entries of a generation of a worker's cache of distinct words.
CACHE_ENTRIES = 400_000


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with their texts as Python strings (null stays None)."""
    at = 0
    while at < batch.num_rows:
        part = batch.slice(at, SLICE_ROWS)
        texts = part.column(text).to_pylist()
        size = 0
        for k, t in enumerate(texts):
            size += len(t or "")
            if size > SLICE_CHARS and k:
                part, texts = part.slice(0, k), texts[:k]
                break
        yield part, texts
        at += len(texts)


def map_texts(df: DataFrame, keep: list[str], schema: str, make: Callable[[], Callable[[pa.RecordBatch, list], dict]]) -> DataFrame:
    """Run a per-slice function over ``keep + text`` and return its columns.

    ``make`` is called once per task and returns the function, which gets a slice and
    its texts and returns a dict of column values.  What a worker may keep from task
    to task (vocabularies, caches) belongs to an object that ``make`` gets from
    :func:`held`.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    spark_schema = _parse_datatype_string(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes reference cycles, and scanning large caches for them is dear
        try:
            work = make()
            for batch in batches:
                for part, texts in slices(batch):
                    got = work(part, texts)
                    yield pa.RecordBatch.from_arrays([x if isinstance(x := got[f.name], pa.Array) else pa.array(x, f.type) for f in arrow], schema=arrow)
        finally:
            gc.enable()

    return df.select(*keep).mapInArrow(run, spark_schema)


def filter_texts(df: DataFrame, text: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows, with all their columns, for which a per-slice function of the texts gives true."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            keep = make()
            for batch in batches:
                for part, texts in slices(batch, text):
                    yield part.filter(pa.array(keep(texts), pa.bool_()))
        finally:
            gc.enable()

    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)


class Cache(dict):
    """A bounded dict of what is known of distinct words, in two generations.

    When the young generation is full it becomes the old one, whose entries return
    to the young one as they are asked for; what was rare is forgotten.  It is full by
    its entries or, where ``nbytes`` is given, by the bytes of its keys and values.
    """

    def __init__(self, entries: int | None = None, nbytes: int | None = None) -> None:
        super().__init__()
        self.entries = entries or (sys.maxsize if nbytes else CACHE_ENTRIES)
        self.nbytes, self.spent, self.seen = nbytes, 0, 0
        self.old: dict = {}

    def recall(self, key):
        """The old generation's value, moved to the young one; None if there is none."""
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def unknown(self, keys) -> list:
        """Those keys that neither generation has; what the old one has moves to the young one."""
        old = self.old
        if not old:
            return list(keys)
        self.update([(k, old[k]) for k in keys if k in old])
        return [k for k in keys if k not in old]

    def trim(self) -> None:
        """Retire the young generation if it is full.

        An entry's place in the table is taken as 100 bytes; values are taken as flat.
        """
        if self.nbytes:
            new = len(self) - self.seen
            for part in (self.keys(), self.values()):
                self.spent += sum(map(sys.getsizeof, islice(reversed(part), new)))
            self.spent += 100 * new
            self.seen = len(self)
        if len(self) > self.entries or (self.nbytes and self.spent > self.nbytes):
            self.old = dict(self)
            self.clear()
            self.spent = self.seen = 0


_held: dict = {}


def held(key: tuple, make: Callable[[], object]):
    """The one object that a worker keeps from task to task; asking for another drops it, so caches of several operators never add up."""
    if key not in _held:
        if _held:
            _held.clear()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps freed memory otherwise
                trim(0)
        _held[key] = make()
    return _held[key]


def learnable(doc_id: Column) -> Column:
    """True for rows a model may learn from: crc32 of the id as text, mod 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def is_held_out(doc_id: Column) -> Column:
    """The complement of :func:`learnable`; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
