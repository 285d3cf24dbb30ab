"""What the order in which rows lie says about them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A task that finds more ascending runs than this reads rows in no order that would help.
RUNS_PER_TASK = 1000
# Which part of which file a row was read from; a task may read several, with others between them.
PART = "_part"


def _runs(keys: list[str], most: int):
    """The first and last keys of each strictly ascending run of a task's rows, within a part.

    Beyond ``most`` runs there is one row of nulls instead. Both functions are defined inside so
    that they are shipped by value to the Python workers.
    """

    def ascends(earlier: pa.Table, later: pa.Table) -> pa.ChunkedArray:
        """Whether each row's keys are below those of the row in the same place of the same part.

        Never beside a null.
        """
        found = None
        for key in reversed(keys):
            less = pc.less(earlier[key], later[key])
            tied = None if found is None else pc.and_(pc.equal(earlier[key], later[key]), found)
            found = less if tied is None else pc.or_(less, tied)
        return pc.and_(pc.equal(earlier[PART], later[PART]), pc.fill_null(found, False))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts, before = [], [], None
        for batch in batches:
            if not batch.num_rows or len(firsts) > most:
                continue
            rows = pa.Table.from_batches([batch])
            if before is None:
                firsts.append(rows.slice(0, 1).to_pylist()[0])
            else:
                rows = pa.concat_tables([before, rows])
            n = rows.num_rows
            up = ascends(rows.slice(0, n - 1), rows.slice(1))
            breaks = pc.indices_nonzero(pc.invert(up).combine_chunks()).slice(0, most + 1)
            for at in breaks.to_pylist():
                lasts.append(rows.slice(at, 1).to_pylist()[0])
                firsts.append(rows.slice(at + 1, 1).to_pylist()[0])
            # A copy, so that the batch it lies in can be freed.
            before = pa.Table.from_pylist(rows.slice(n - 1).to_pylist(), rows.schema)
        if before is None:
            return
        lasts.extend(before.to_pylist())
        if len(firsts) > most:
            firsts = lasts = [dict.fromkeys(keys)]
        ends = [
            {f"{side}_{key}": row[key] for side, row in (("first", f), ("last", s)) for key in keys}
            for f, s in zip(firsts, lasts)
        ]
        names = [(f"{side}_{key}", before.schema.field(key).type) for side in ("first", "last") for key in keys]
        yield pa.RecordBatch.from_pylist(ends, pa.schema(names))

    return run


def proven_unique(rows: DataFrame, *keys: str, most: int = RUNS_PER_TASK) -> bool:
    """Whether the order of ``rows`` proves that no two agree in ``keys``, strings or whole numbers.

    Rows read from files in key order make few strictly ascending runs; if none of these runs
    overlap, all keys differ. That takes one pass and no shuffle. False means not proven.
    """
    names = list(keys)
    types = {key: rows.schema[key].dataType for key in names}
    if not all(isinstance(kind, (T.StringType, T.LongType, T.IntegerType)) for kind in types.values()):
        return False
    schema = T.StructType(
        [T.StructField(f"{side}_{key}", types[key]) for side in ("first", "last") for key in names]
    )
    part = F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias(PART)
    runs = rows.select(*names, part).mapInArrow(_runs(names, most), schema)
    first, last = ([F.col(f"{side}_{key}") for key in names] for side in ("first", "last"))

    def whole(columns):
        return F.struct(*[column.alias(key) for column, key in zip(columns, names)])

    # A few rows per task.
    following = F.lead(whole(first)).over(Window.orderBy(*first, *last))
    unknown = F.lit(False)
    for column in (*first, *last):
        unknown = unknown | column.isNull()
    placed = runs.select(unknown.alias("unknown"), whole(last).alias("last"), following.alias("next"))
    unproven = F.col("unknown") | (F.col("next").isNotNull() & ~(F.col("last") < F.col("next")))
    return placed.filter(unproven).isEmpty()
