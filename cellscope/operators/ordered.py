"""Order-dependent operators that stay balanced when one key is huge.

A ``Window.partitionBy(key)`` puts every row of a key into one task; if one
user or region holds a third of all rows, that task holds a third of the job.
Here rows are range-partitioned on the *full* order key, so a hot key is
spread over many contiguous partitions.  A partition is then scanned once, in
its order, batch by batch: only its first key can continue an earlier
partition, so what it needs from there (the last row, the sums so far) is one
carry.  A first scan returns one row for each partition (its first and last
key and what the last key leaves behind); the driver threads these rows, at
most one for each partition, into the carries.  After the range exchange no
row is exchanged or sorted again, and there is one path for all keys.

Row numbering inside a partition uses ``monotonically_increasing_id`` whose
documented layout is ``partition_index << 33 | row_number_in_partition``.  The
tagged rows feed two plan branches (the per-partition summary and the rows
themselves).  Two separate range exchanges would each sample their own
boundaries, and when the input comes out of an earlier shuffle the samples
can differ; so the tagged rows are written once with a reliable
``checkpoint()`` into the shared checkpoint folder and both branches read the
same files.  This also cuts lineage: a lost executor re-reads the checkpoint
instead of recomputing the upstream joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.session import default_parallelism

_LOCAL_MASK = (1 << 33) - 1


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    return num_partitions or default_parallelism(df.sparkSession)


def range_tagged(df: DataFrame, order_cols: Sequence[str],
                 num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort on ``order_cols``; add ``_part`` and ``_local``.

    The result is checkpointed (see module doc), so it can be consumed by
    several branches of one plan.
    """
    n = _partitions(df, num_partitions)
    mid = F.monotonically_increasing_id()
    tagged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_mid", mid)
                .withColumn("_part", F.shiftright("_mid", 33).cast("int"))
                .withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
                .drop("_mid"))
    return tagged.checkpoint(eager=True)


def with_row_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "row_index",
                   num_partitions: int | None = None) -> DataFrame:
    """Dense 0-based position of every row in the total order ``order_cols``.

    Equals ``row_number() OVER (ORDER BY order_cols) - 1`` when the order key
    is unique, but never moves the data into one partition.
    """
    tagged = range_tagged(df, order_cols, num_partitions)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # <= num_partitions rows: a proven bound, safe to broadcast.
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (tagged.join(F.broadcast(offsets), "_part")
                  .withColumn(index_col, F.col("_offset") + F.col("_local"))
                  .drop("_part", "_local", "_offset"))


def unique_row_ids(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """``RDD.zipWithUniqueId`` semantics on a DataFrame: k-th row of partition
    i out of n gets ``k * n + i`` (unique, gap-prone, partitioning-dependent)."""
    n = df.rdd.getNumPartitions()
    mid = F.monotonically_increasing_id()
    return (df.withColumn("_mid", mid)
              .withColumn(id_col, F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)) * n
                          + F.shiftright("_mid", 33))
              .drop("_mid"))


def _no_change(column, earlier):
    """True where a value equals the one before it (nulls equal nulls)."""
    import pyarrow.compute as pc

    same = pc.fill_null(pc.equal(column, earlier), False)
    return pc.or_(same, pc.and_(pc.is_null(column), pc.is_null(earlier)))


def _shifted(column, before):
    """The column one row later, beginning with the value ``before`` (an array of one)."""
    import pyarrow as pa

    return pa.concat_arrays([before.cast(column.type), column.slice(0, len(column) - 1)])


class _Scan:
    """One partition's rows in order.  ``step`` gets every batch with the places where a
    key's rows begin and whether its first row continues the state kept so far."""

    def __init__(self, keys, state, step):
        self.keys, self.state, self.step = keys, state, step
        self.first = self.last = None
        self.one_key = True

    def run(self, batches, carry):
        """``carry(part)`` is the state left to the partition's first key, or None."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in self.keys]
            begins = self.last is None
            if begins:
                self.part = batch.column("_part")[0].as_py()
                self.first = self.last = [c.slice(0, 1) for c in columns]
                held = carry(self.part)
                if held is not None:
                    self.state = held
            same = np.ones(batch.num_rows, bool)
            for c, before in zip(columns, self.last, strict=True):
                same &= _no_change(c, _shifted(c, before)).to_numpy(zero_copy_only=False)
            if begins:
                same[0] = held is not None
                self.one_key = bool(same[1:].all())
            else:
                self.one_key &= bool(same.all())
            made = self.step(self, batch, same)
            # Copies of one row: a slice would keep its whole batch.
            self.last = [pa.array(c.slice(len(c) - 1).to_pylist(), c.type) for c in columns]
            if made is not None:
                yield made


def _carries(tagged: DataFrame, keys: list[str], fields: list[T.StructField], make, join) -> dict:
    """What each partition's first key brings along from earlier ones: the states that a
    first scan returns, one row for each partition, threaded in partition order.
    ``join(before, own)`` is the state after a partition that holds one key alone."""
    key_fields = [tagged.schema[k] for k in keys]
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("one_key", T.BooleanType()),
        *[T.StructField(f"f{i}", f.dataType) for i, f in enumerate(key_fields)],
        *[T.StructField(f"l{i}", f.dataType) for i, f in enumerate(key_fields)],
        *[T.StructField(f"s{i}", f.dataType) for i, f in enumerate(fields)]])

    def tail(batches):
        import pyarrow as pa

        scan = make(False)
        for _ in scan.run(batches, lambda part: None):
            pass
        if scan.last is not None:
            row = [pa.array([scan.part], pa.int32()), pa.array([scan.one_key]), *scan.first, *scan.last, *scan.state]
            yield pa.RecordBatch.from_arrays(row, names)

    names = schema.names
    rows = sorted(tagged.mapInArrow(tail, schema).collect(), key=lambda r: r["part"])
    carries, left = {}, None
    for r in rows:
        first, last = ([r[f"{x}{i}"] for i in range(len(keys))] for x in "fl")
        state = [r[f"s{i}"] for i in range(len(fields))]
        if left is not None and left[0] == first:
            carries[r["part"]] = left[1]
            if r["one_key"]:
                state = join(left[1], state)
        left = (last, state)
    return carries


def _scanned(tagged: DataFrame, keys: list[str], fields: list[T.StructField], make, join) -> DataFrame:
    carries = _carries(tagged, keys, fields, make, join)
    schema = T.StructType([*tagged.schema.fields, *fields])
    types = [f.dataType for f in fields]

    def scan(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        def carry(part):
            held = carries.get(part)
            return held and [pa.array([v.asDict() if hasattr(v, "asDict") else v], to_arrow_type(t))
                             for v, t in zip(held, types, strict=True)]

        yield from make(True).run(batches, carry)

    return tagged.mapInArrow(scan, schema)


def lag_tagged(tagged: DataFrame, key_cols: Sequence[str], value_cols: Sequence[str],
               prefix: str = "prev_") -> DataFrame:
    """Previous row's values within each key, for the rows of :func:`range_tagged` or a
    subset of them; keeps order, ``_part`` and ``_local`` for further passes over them."""
    keys, vals = list(key_cols), list(value_cols)
    fields = [T.StructField(f"{prefix}{v}", tagged.schema[v].dataType) for v in vals]
    names = [*tagged.columns, *[f.name for f in fields]]

    def make(emit: bool) -> _Scan:
        def step(scan, batch, same):
            import pyarrow as pa
            import pyarrow.compute as pc

            columns = [batch.column(v) for v in vals]
            made = None
            if emit:
                keep = pa.array(same)
                before = scan.state or [pa.nulls(1, c.type) for c in columns]
                lagged = [pc.if_else(keep, _shifted(c, b), pa.nulls(len(c), c.type))
                          for c, b in zip(columns, before, strict=True)]
                made = pa.RecordBatch.from_arrays([*batch.columns, *lagged], names)
            scan.state = [pa.array(c.slice(len(c) - 1).to_pylist(), c.type) for c in columns]
            return made
        return _Scan(keys, None, step)

    return _scanned(tagged, keys, fields, make, lambda before, own: own)


def lag_columns(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                value_cols: Sequence[str], prefix: str = "prev_",
                num_partitions: int | None = None) -> DataFrame:
    """``lag(v) OVER (PARTITION BY key ORDER BY order)``, whatever the key skew."""
    tagged = range_tagged(df, [*key_cols, *order_cols], num_partitions)
    return lag_tagged(tagged, key_cols, value_cols, prefix).drop("_part", "_local")


def last_tagged(tagged: DataFrame, key_cols: Sequence[str], flag: str, value_cols: Sequence[str],
                prefix: str = "last_") -> DataFrame:
    """Values of the latest row so far, the row itself included, whose ``flag`` is true, within
    each key, for the rows of :func:`range_tagged`; null before the first one."""
    keys, vals = list(key_cols), list(value_cols)
    fields = [T.StructField(f"{prefix}{v}", tagged.schema[v].dataType) for v in vals]
    found = T.StructField("_found", T.BooleanType())
    names = [*tagged.columns, *[f.name for f in fields], "_found"]

    def make(emit: bool) -> _Scan:
        def step(scan, batch, same):
            import numpy as np
            import pyarrow as pa

            n, columns = batch.num_rows, [batch.column(v) for v in vals]
            held = scan.state or [*[pa.nulls(1, c.type) for c in columns], pa.array([False])]
            flagged = batch.column(flag).fill_null(False).to_numpy(zero_copy_only=False)
            # Place of the latest flagged row, from 1; 0 is what was held before this batch.
            at = np.maximum.accumulate(np.where(flagged, np.arange(1, n + 1), 0))
            begin = np.maximum.accumulate(np.where(same, 0, np.arange(1, n + 1)))
            gone = (begin > 0) & (at < begin)       # it belongs to an earlier key
            place = pa.array(at, mask=gone)
            last = [pa.concat_arrays([h.cast(c.type), c]).take(place) for h, c in zip(held[:-1], columns, strict=True)]
            seen = pa.array(np.where(gone, False, (at > 0) | bool(held[-1][0].as_py())))
            scan.state = [pa.array(c.slice(n - 1).to_pylist(), c.type) for c in [*last, seen]]
            return pa.RecordBatch.from_arrays([*batch.columns, *last, seen], names) if emit else None
        return _Scan(keys, None, step)

    return _scanned(tagged, keys, [*fields, found], make,
                    lambda before, own: own if own[-1] else before).drop("_found")


def running_tagged(tagged: DataFrame, key_cols: Sequence[str], sums: Mapping[str, str],
                   xors: Mapping[str, str] | None = None) -> DataFrame:
    """Inclusive running sums and XORs (new name -> long column, nulls count as 0) within each
    key, for the rows of :func:`range_tagged` or a subset; keeps order, ``_part``, ``_local``."""
    keys, xors = list(key_cols), dict(xors or {})
    wanted = [*[(n, c, True) for n, c in sums.items()], *[(n, c, False) for n, c in xors.items()]]
    fields = [T.StructField(n, T.LongType()) for n, _, _ in wanted]
    names = [*tagged.columns, *[f.name for f in fields]]

    def make(emit: bool) -> _Scan:
        def step(scan, batch, same):
            import numpy as np
            import pyarrow as pa
            import pyarrow.compute as pc

            begin = np.flatnonzero(~same)
            made = []
            for (_, column, add), held in zip(wanted, scan.state, strict=True):
                x = pc.fill_null(batch.column(column).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                # Each key's total starts anew: take off what stands before its first row.
                total = np.cumsum(x) if add else np.bitwise_xor.accumulate(x)
                before = total[begin] - x[begin] if add else total[begin] ^ x[begin]
                start = np.concatenate([-held.to_numpy() if add else held.to_numpy(), before])
                off = np.repeat(start, np.diff(np.concatenate([[0], begin, [len(x)]])))
                made.append(pa.array(total - off if add else total ^ off))
            scan.state = [pa.array([m[-1].as_py()], pa.int64()) for m in made]
            return pa.RecordBatch.from_arrays([*batch.columns, *made], names) if emit else None
        return _Scan(keys, [pa_zero() for _ in wanted], step)

    def pa_zero():
        import pyarrow as pa

        return pa.array([0], pa.int64())

    def join(before: list, own: list) -> list:
        return [_wrapped(b + o) if add else b ^ o for b, o, (_, _, add) in zip(before, own, wanted, strict=True)]

    return _scanned(tagged, keys, fields, make, join)


def _wrapped(n: int) -> int:
    """A sum as a 64-bit integer holds it."""
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def running_sums(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                 sums: Mapping[str, Column], num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums per group, one output per input row.

    Same result as ``sum(x) OVER (PARTITION BY g ORDER BY o ROWS BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW)`` where no x is null.
    """
    tagged = range_tagged(df.select("*", *[c.cast("long").alias(f"_x_{n}") for n, c in sums.items()]),
                          [*group_cols, *order_cols], num_partitions)
    return running_tagged(tagged, group_cols, {n: f"_x_{n}" for n in sums}).select(*df.columns, *sums)
