"""Log-structured keyed table: append-only deltas, tombstones, size-tiered
compaction, buckets that double (K6, ST3).

A batch is reduced to its latest row per key and written as one *delta*
segment, files sorted by key hash, so it costs what the batch holds, however large
the table is and however widely its keys are spread.  A row wins over another
of its key by the order columns, then as a tombstone, then by every other
column; that order is total, so reducing any set of segments in any sequence
gives the same rows, and late data sorts itself in.

Segments have tiers.  As soon as ``fanout`` segments share a tier they are
merged into one of the next, so a row is rewritten once per tier (logarithmic
in the number of batches) and at most ``fanout - 1`` segments a tier are live.
Merges keep tombstones: an older segment, or a late row still to come, may hold
the key.  ``compact`` merges everything and drops the tombstones that its
caller says no late row can precede (those before a watermark, say).

Merged segments are laid out in hash buckets, ``2 ** k`` of them.  A bucket is
a range of the key hash, so doubling cuts every bucket in two and leaves older
segments readable beside newer ones; the count grows with the rows and is
stored with each segment.  A file holds whole buckets, in order, and as many as
make a file of fair size, so files do not multiply with buckets; a look-up
skips by the bounds of bucket and hash that files keep per row group and page.

A version is committed by its manifest: one row with the live segments, the
key, the order and, per stream, the last epoch it holds.  A replayed epoch is
passed over; leftovers of a failed write are never referenced.  The driver
handles the newest manifest only, whose size is the number of live segments.
One writer at a time; readers are never disturbed, as nothing is overwritten.
``vacuum`` removes what the newest versions no longer name.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import children, remove

HASH, DELETED, BUCKET = "__hash", "__deleted", "__bucket"
HASH_BITS = 32
MANIFEST = ("key string, `order` array<string>, applied map<string, long>, appended long, merged long, "
            "segments array<struct<path: string, tier: int, rows: long, buckets: int>>, version long")


@dataclass(frozen=True)
class Segment:
    path: str
    tier: int
    rows: int
    #: 0: a delta, sorted by hash but not laid out in buckets
    buckets: int


@dataclass(frozen=True)
class State:
    """What a manifest says; ``appended`` and ``merged`` count the rows that
    its version wrote as a delta and in compactions."""
    version: int
    key: str
    order: tuple
    segments: tuple = ()
    applied: dict = field(default_factory=dict)
    appended: int = 0
    merged: int = 0


def manifests(spark: SparkSession, target: str) -> DataFrame | None:
    """All committed manifests, None before the first; any failure but a
    missing folder is raised."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{target.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, target: str) -> State | None:
    """The newest committed state."""
    found = manifests(spark, target)
    row = None if found is None else found.orderBy(F.desc("version")).first()
    if row is None:
        return None
    return State(row["version"], row["key"], tuple(row["order"]), tuple(Segment(*s) for s in row["segments"]),
                 dict(row["applied"] or {}), row["appended"], row["merged"])


def _commit(spark: SparkSession, target: str, state: State) -> None:
    row = asdict(state) | {"order": list(state.order), "segments": [tuple(asdict(s).values()) for s in state.segments]}
    names = ["key", "order", "applied", "appended", "merged", "segments"]
    schema = MANIFEST.rsplit(",", 1)[0]
    df = spark.createDataFrame([tuple(row[n] for n in names)], schema)
    # the version is new, so a folder of that name can only be a failed commit's
    df.coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}/manifest/version={state.version:012d}")


# ------------------------------------------------------------------ merging


def key_hash(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(1 << HASH_BITS))


def bucket_of(buckets: int) -> Column:
    """Bucket of a row: its hash's leading bits, so doubling splits buckets."""
    return F.expr(f"CAST({HASH} * {buckets} div {1 << HASH_BITS} AS INT)")


def latest(rows: DataFrame, key: str, order) -> DataFrame:
    """One row per key: the greatest by order, tombstone, then every other
    column.  A partial aggregate: a hot key costs one row per task."""
    rest = [c for c in rows.columns if c not in (key, HASH, DELETED, *order)]
    packed = F.struct(*order, DELETED, *rest)
    return rows.groupBy(HASH, key).agg(F.max(packed).alias("__m")).select(HASH, key, "__m.*").select(*rows.columns)


def _scan(spark: SparkSession, segment: Segment) -> DataFrame:
    df = spark.read.parquet(segment.path)
    return df.drop(BUCKET) if segment.buckets else df


def merged(spark: SparkSession, segments, key: str, order) -> DataFrame:
    """Latest row per key over the segments, tombstones included.

    The largest segment has one row per key already: what the others do not
    touch passes through an anti join (no shuffle of it while the others'
    keys are few: the optimizer's runtime size check decides)."""
    by_size = sorted(segments, key=lambda s: (s.rows, s.path))
    frames = [_scan(spark, s) for s in by_size]
    if len(frames) == 1:
        return frames[0]
    news = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames[:-1])
    keys = news.select(F.col(HASH).alias("__h"), F.col(key).alias("__k")).distinct()
    base = frames[-1]
    # null keys are keys too
    same = (F.col(HASH) == F.col("__h")) & F.col(key).eqNullSafe(F.col("__k"))
    touched = base.join(keys, same, "left_semi").unionByName(news, allowMissingColumns=True)
    return base.join(keys, same, "left_anti").unionByName(latest(touched, key, order), allowMissingColumns=True)


def _grown(buckets: int, rows: int, bucket_rows: int) -> int:
    while buckets * bucket_rows < rows:
        buckets *= 2
    return buckets


def _compact(spark: SparkSession, target: str, state: State, fanout: int, buckets: int, bucket_rows: int) -> State:
    """Merge full tiers until none is full."""
    while True:
        tiers: dict[int, list[Segment]] = {}
        for s in state.segments:
            tiers.setdefault(s.tier, []).append(s)
        full = [t for t, own in sorted(tiers.items()) if len(own) >= fanout]
        if not full:
            return state
        state = _merge(spark, target, state, tiers[full[0]], full[0] + 1, buckets, bucket_rows)


def _merge(spark: SparkSession, target: str, state: State, own: list[Segment], tier: int, buckets: int, bucket_rows: int,
           forget: Column | None = None) -> State:
    rows = merged(spark, own, state.key, state.order)
    if forget is not None:
        rows = rows.where(~(F.col(DELETED) & F.coalesce(forget, F.lit(False))))
    buckets = _grown(max([buckets, *(s.buckets for s in state.segments)]), sum(s.rows for s in own), bucket_rows)
    path = f"{target.rstrip('/')}/data/{state.version:012d}-t{tier}-{uuid.uuid4().hex[:8]}"
    laid = rows.withColumn(BUCKET, bucket_of(buckets)).repartition(BUCKET).sortWithinPartitions(BUCKET, HASH, state.key)
    laid.write.parquet(path)
    n = spark.read.schema(laid.schema).parquet(path).count()
    left = tuple(s for s in state.segments if s not in own)
    made = (Segment(path, tier, n, buckets),) if n else ()
    return replace(state, segments=left + made, merged=state.merged + n)


# ---------------------------------------------------------------- interface


def upsert(spark: SparkSession, target: str, batch: DataFrame, key: str, order, batch_id: tuple[str, int] | None = None,
           deleted: Column | None = None, fanout: int = 4, buckets: int = 4, bucket_rows: int = 4_000_000) -> bool:
    """Apply a batch; rows for which ``deleted`` holds remove their key.

    ``batch_id`` (stream, epoch) is remembered: an epoch that the table holds
    already is passed over (False).  Epochs of a stream come in order."""
    order = [order] if isinstance(order, str) else list(order)
    old = newest(spark, target)
    if old and (old.key, list(old.order)) != (key, order):
        raise ValueError(f"{target} is kept by {old.key} and {list(old.order)}")
    if old and batch_id and old.applied.get(batch_id[0], -1) >= batch_id[1]:
        return False
    state = State(old.version + 1 if old else 0, key, tuple(order), old.segments if old else (), dict(old.applied) if old else {})
    dead = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    rows = latest(batch.withColumn(HASH, key_hash(key)).withColumn(DELETED, dead), key, order)
    path = f"{target.rstrip('/')}/data/{state.version:012d}-t0-{uuid.uuid4().hex[:8]}"
    # as the aggregate has dealt them: a range partitioning would run the batch twice, once to sample it
    rows.sortWithinPartitions(HASH, key).write.parquet(path)
    n = spark.read.schema(rows.schema).parquet(path).count()
    if batch_id:
        state.applied[batch_id[0]] = batch_id[1]
    if n:
        state = replace(state, segments=(*state.segments, Segment(path, 0, n, 0)), appended=n)
    _commit(spark, target, _compact(spark, target, state, fanout, buckets, bucket_rows))
    return True


def compact(spark: SparkSession, target: str, forget: Column | None = None, buckets: int = 4, bucket_rows: int = 4_000_000) -> None:
    """Merge all live segments into one, without the tombstones for which
    ``forget`` holds (a condition on the row's columns)."""
    state = newest(spark, target)
    if state and state.segments:
        state = replace(state, version=state.version + 1, appended=0, merged=0)
        tier = max(s.tier for s in state.segments)
        _commit(spark, target, _merge(spark, target, state, list(state.segments), max(1, tier), buckets, bucket_rows, forget))


def _shown(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col(DELETED)).drop(HASH, DELETED)


def read(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The table's rows: of the newest version, or of an earlier one that is still there."""
    state = newest(spark, target)
    if state and version is not None and version != state.version:
        row = manifests(spark, target).where(F.col("version") == version).first()
        state = row and replace(state, segments=tuple(Segment(*s) for s in row["segments"]))
    if not state:
        raise FileNotFoundError(f"no committed version under {target}")
    if not state.segments:
        raise FileNotFoundError(f"no rows were ever kept under {target}")
    return _shown(merged(spark, state.segments, state.key, state.order))


def lookup(spark: SparkSession, target: str, keys: list) -> DataFrame:
    """Rows of a few keys: only their buckets and, within sorted files, their
    hash ranges are read."""
    state = newest(spark, target)
    if not state or not state.segments:
        raise FileNotFoundError(f"no committed version under {target}")
    kind = _scan(spark, state.segments[0]).schema[state.key].dataType
    wanted = spark.createDataFrame([(k,) for k in keys], f"`{state.key}` {kind.simpleString()}")
    hashes = [r[0] for r in wanted.select(key_hash(state.key)).collect()]
    parts = []
    for s in state.segments:
        df = spark.read.parquet(s.path)
        if s.buckets:
            df = df.where(F.col(BUCKET).isin([h * s.buckets >> HASH_BITS for h in hashes])).drop(BUCKET)
        parts.append(df.where(F.col(HASH).isin(hashes) & F.col(state.key).isin(keys)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _shown(latest(rows, state.key, state.order))


def segments(spark: SparkSession, target: str) -> DataFrame:
    """Live segments: path, tier, rows, buckets."""
    state = newest(spark, target)
    return spark.createDataFrame([tuple(asdict(s).values()) for s in state.segments] if state else [], "path string, tier int, rows long, buckets int")


def vacuum(spark: SparkSession, target: str, keep: int = 1) -> int:
    """Remove manifests before the newest ``keep`` and the data that the kept
    ones do not name; the number of removed folders.  Not while a writer runs."""
    found = manifests(spark, target)
    if found is None:
        return 0
    kept = found.orderBy(F.desc("version")).limit(keep).collect()
    names = {s["path"].rsplit("/", 1)[-1] for r in kept for s in r["segments"]}
    versions = {f"version={r['version']:012d}" for r in kept}
    root, gone = target.rstrip("/"), 0
    for folder, live in (("manifest", versions), ("data", names)):
        for name in children(spark, f"{root}/{folder}"):
            if name not in live and not name.startswith("_"):
                remove(spark, f"{root}/{folder}/{name}")
                gone += 1
    return gone
