"""Distance to a set of vectors (V4) and refinement against a set."""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..plans.bank import broadcast_banks, vector_table_size
from ..plans.keys import RowKey, quoted
from ..plans.session import DEFAULT_BROADCAST_BYTES, attach, default_parallelism, materialize
from .refine import same_numpy
from .scoring import VectorSpec, set_min_scorer
from .sfs import RefineOptions, SetState, query_box_start, set_distances, step_all

# parts of a set that one pass over the rows holds at a time
PARTS_PER_PASS = 4
# members of a set that one row holds, and rows of a set that meet one copy of its trial points
CHUNK_MEMBERS = 4096
CHUNKS_PER_PART = 16
# sets whose sizes are broadcast to the rows (some 50 bytes each)
BROADCAST_SETS = 100_000
POINTS = "s long, best_point array<double>, best_fit double"


def _whole(vec: Column) -> Column:
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull())


def min_distance_to_set(df: DataFrame, members: DataFrame, vec="embedding",
                        member_col: str = "embedding", id_col="id",
                        out: str = "min_dist",
                        broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                        passthrough: list[str] | None = None) -> DataFrame:
    """V4: ``min(1, min_i cosdist(row, member_i))`` for every row.

    Returns the key columns, ``passthrough`` and ``out``, a row for each row
    of ``df``.  A row is compared with the valid members of its own length
    (NULL members, members with a NULL element and members of other lengths
    do not take part); a zero norm makes that pair's distance 1.  A row that
    is NULL, holds a NULL element, or has no member of its length gets NULL;
    with a set that has no valid member at all every valid row gets 1.

    ``members`` is evaluated once.  A set above ``broadcast_bytes`` is cut
    into several broadcasts that lower each row's minimum one after the other
    in the task that holds the row: rows are never shuffled or joined back.
    """
    spark = df.sparkSession
    attach(spark)
    spec, key = VectorSpec(vec), RowKey(df, id_col)
    names = key.names + [c for c in passthrough or [] if c not in key.names]
    point = quoted(member_col).cast("array<double>")
    held = materialize(members.filter(_whole(point)).select(point.alias("__p")), "set")
    rows, elements = vector_table_size(held, "__p")
    frame = df.select(*[quoted(c).alias(f"__c{i}") for i, c in enumerate(names)], *spec.select())
    schema = StructType(frame.schema.fields + [StructField("__m", DoubleType()), StructField("__s", BooleanType())])
    for i, bank in enumerate(broadcast_banks(held, "__p", [], rows, elements, broadcast_bytes)):
        if i and i % PARTS_PER_PASS == 0:
            frame = materialize(frame, "set-minima")
        frame = frame.mapInArrow(set_min_scorer(bank, spec.inner(), i == 0, rows == 0), schema)
    return frame.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)],
                        F.when(F.col("__s"), F.col("__m")).alias(out))


def _packed(points: np.ndarray) -> bytes:
    return np.ascontiguousarray(points, dtype=np.float64).tobytes()


def _members(lists: pa.Array, i: int, dim: int) -> np.ndarray:
    return lists[i].values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _set_seed(value, opts: RefineOptions) -> int:
    return (zlib.crc32(repr(value).encode()) ^ (int(opts.seed) & 0xFFFFFFFF)) & 0xFFFFFFFF


def _stored(state: SetState) -> bytes:
    """A search's state with its random stream, as the table keeps it."""
    return pickle.dumps((state.particles, state.fits, state.best, state.rng.bit_generator.state))


def _restored(image: bytes) -> SetState:
    particles, fits, best, stream = pickle.loads(image)
    rng = np.random.Generator(np.random.SFC64(0))
    rng.bit_generator.state = stream
    state = SetState(particles, rng)
    state.fits, state.best = fits, best
    return state


def _whole_searches(opts: RefineOptions):
    """Searches of sets whose members are in one row, from the first particle to the last generation."""
    version = np.__version__

    def run(batches):
        same_numpy(version)
        for batch in batches:
            points, fits = [], []
            for i, (value, dim) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                members = _members(batch.column(3), i, dim)

                def fit(p):
                    return np.fmin(1.0, set_distances(p, members))

                x = query_box_start(dim, opts, _set_seed(value, opts))
                x.start(fit(x.particles))
                for _ in range(int(opts.generations)):
                    trials = step_all(x, opts)
                    x.accept(trials, fit(trials.reshape(-1, dim)).reshape(trials.shape[:2]))
                points.append(x.particles[x.best])
                fits.append(float(x.fits[x.best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(points, pa.list_(pa.float64())),
                                              pa.array(fits, pa.float64())], names=["s", "best_point", "best_fit"])
    return run


STATE = "s long, dim int, state binary, trials binary"


def _started(opts: RefineOptions):
    version = np.__version__

    def run(batches):
        same_numpy(version)
        for batch in batches:
            made = [query_box_start(d, opts, _set_seed(g, opts))
                    for g, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), pa.array([_stored(x) for x in made], pa.binary()),
                 pa.array([_packed(x.particles) for x in made], pa.binary())], names=["s", "dim", "state", "trials"])
    return run


def _minima(batches):
    """Per part of a set, the smallest distance from each trial point to its members."""
    for batch in batches:
        low = []
        for i, dim in enumerate(batch.column(1).to_pylist()):
            trials = np.frombuffer(batch.column(2)[i].as_buffer(), np.float64).reshape(-1, dim)
            low.append(np.fmin(1.0, set_distances(trials, _members(batch.column(3), i, dim))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low, pa.list_(pa.float64()))], names=["s", "m"])


def _stepped(opts: RefineOptions, first: bool):
    """Each search takes what its trial points met and draws the next ones."""
    version = np.__version__

    def run(batches):
        same_numpy(version)
        for batch in batches:
            states, trials = [], []
            for i, dim in enumerate(batch.column(1).to_pylist()):
                x = _restored(batch.column(2)[i].as_py())
                fits = batch.column(4)[i].values.to_numpy(zero_copy_only=False)
                if first:
                    x.start(fits)
                else:
                    tried = np.frombuffer(batch.column(3)[i].as_buffer(), np.float64)
                    shape = (len(x.particles), int(opts.diffusion))
                    x.accept(tried.reshape(*shape, dim), fits.reshape(shape))
                trials.append(_packed(step_all(x, opts)))
                states.append(_stored(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(states, pa.binary()),
                                              pa.array(trials, pa.binary())], names=["s", "dim", "state", "trials"])
    return run


def _best(batches):
    for batch in batches:
        states = [_restored(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x.particles[x.best] for x in states], pa.list_(pa.float64())),
             pa.array([float(x.fits[x.best]) for x in states], pa.float64())], names=["s", "best_point", "best_fit"])


def _table_searches(sets: DataFrame, chunks: DataFrame, opts: RefineOptions) -> DataFrame:
    """Searches of sets in several chunks: a table of states, rewritten once per generation.

    Trial points go to the chunks of their set by a join on the set and one
    of its parts, so that the chunks of one set spread over tasks; the minima
    of the parts meet in an aggregate.
    """
    parts = F.ceil(F.col("chunks") / F.lit(CHUNKS_PER_PART)).cast("int")
    held = materialize(chunks.withColumn("part", F.pmod(F.col("c"), parts)).select("s", "part", "dim", "members"),
                       "set-chunks")
    spread = materialize(sets.select("s", parts.alias("parts")), "set-parts")
    state = materialize(sets.select("s", "g", "n").mapInArrow(_started(opts), STATE), "set-states")
    for generation in range(int(opts.generations) + 1):
        asked = (state.join(spread, "s").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                 .select("s", "part", "trials"))
        met = held.join(asked, ["s", "part"]).select("s", "dim", "trials", "members")
        low = (met.mapInArrow(_minima, "s long, m array<double>").select("s", F.posexplode("m").alias("i", "m"))
               .groupBy("s", "i").agg(F.min("m").alias("m"))
               .groupBy("s").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("m"))
               .select("s", F.transform("m", lambda x: x["m"]).alias("m")))
        state = materialize(state.join(low, "s").select("s", "dim", "state", "trials", "m")
                            .mapInArrow(_stepped(opts, generation == 0), STATE), "set-states")
    return state.select("s", "state").mapInArrow(_best, POINTS)


def refine_against_sets(df: DataFrame, by: str, vec: str = "embedding",
                        options: RefineOptions | None = None,
                        broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                        chunk_members: int | None = None) -> DataFrame:
    """Per group, the search with objective ``min(1, min_i cosdist(x, s_i))``.

    Returns ``(by, dim, best_point, best_fit)``, a row for each length of
    valid vectors in a group; a group without a valid vector has one row of
    NULLs.  Members are dealt into chunks of about ``chunk_members`` (by
    default 4096, or fewer if these exceed ``broadcast_bytes``).  A set of
    one chunk is searched in the task that holds it.  A larger one is never
    gathered: its search is a row of a table that is stepped generation by
    generation, with one job each over the chunks.  Neither passes through the
    driver, and both give the same points.  Particles of one generation share
    its first incumbent, where the sequential search lets a particle see the
    improvements of those before it.
    """
    spark = df.sparkSession
    attach(spark)
    opts = options or RefineOptions()
    vector = quoted(vec).cast("array<double>")
    rows = materialize(df.select(quoted(by).alias("g"), F.when(_whole(vector), vector).alias("v"))
                       .withColumn("n", F.when(F.col("v").isNotNull(), F.size("v"))), "set-rows")
    kinds = materialize(rows.groupBy("g", "n").agg(F.count(F.lit(1)).alias("members")), "set-sizes")
    if chunk_members is None:
        widest = kinds.agg(F.max("n")).first()[0] or 1
        chunk_members = max(1, min(CHUNK_MEMBERS, broadcast_bytes // (8 * max(1, widest))))
    whole = kinds.groupBy("g").agg(F.max("n").alias("most"))
    kept = (kinds.join(whole.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2")))
            .filter(F.col("n").isNotNull() | F.col("most").isNull()).select("g", "n", "members"))
    sets = materialize(kept.withColumn("s", F.monotonically_increasing_id())
                       .withColumn("chunks", F.ceil(F.col("members") / F.lit(int(chunk_members))).cast("int")), "sets")
    # which of a set's chunks a row is in: by its place in the written table
    dealt = (rows.filter("n IS NOT NULL").withColumn("h", F.xxhash64(F.monotonically_increasing_id()))
             .join(F.broadcast(sets.select(F.col("g").alias("g2"), F.col("n").alias("n2"), "s", "chunks"))
                   if sets.count() <= BROADCAST_SETS else
                   sets.select(F.col("g").alias("g2"), F.col("n").alias("n2"), "s", "chunks"),
                   F.col("g").eqNullSafe(F.col("g2")) & (F.col("n") == F.col("n2"))))
    chunks = materialize(dealt.withColumn("c", F.pmod("h", F.col("chunks")).cast("int"))
                         .groupBy("s", "c").agg(F.collect_list("v").alias("members"), F.first("n").alias("dim"),
                                                F.first("chunks").alias("chunks")), "set-members")
    one = (chunks.filter("chunks = 1").select("s", "members").join(sets, "s")
           .select("s", "g", "n", chunks["members"].alias("v")).repartition(2 * default_parallelism(spark))
           .mapInArrow(_whole_searches(opts), POINTS))
    found = one
    several = sets.filter("n IS NOT NULL AND chunks > 1")
    if not several.isEmpty():
        found = one.unionByName(_table_searches(several, chunks.filter("chunks > 1"), opts))
    return (sets.join(materialize(found, "set-points"), "s", "left")
            .select(F.col("g").alias(by), F.col("n").cast("int").alias("dim"), "best_point", "best_fit"))


__all__ = ["min_distance_to_set", "refine_against_sets"]
