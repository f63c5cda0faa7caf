"""Session-level helpers shared by every operator: stored tables, size-checked joins, Arrow maps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bound, in rows, of any table this library broadcasts on its own decision. A row takes about 130 bytes in a
#: broadcast, and the driver has it several times over while it is built and sent: the tables of a query add up there.
BROADCAST_ROWS = 100_000
#: A key with more than this share of the counted rows is hot; there can be at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 256
SALTS = 16

_stored: list[tuple[SparkSession, str]] = []


def session(app: str = "tierlens", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE with skew handling)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where none is named, a temporary folder serves a session whose executors all live in this process; any
    other session has executors that could not read it, and gets an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tierlens-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, and readers get just the columns they ask for.

    A lost executor costs one read of the files, not a recomputation. ``discard_stored`` removes the files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    release_native_memory(spark)
    if not _stored:
        atexit.register(discard_stored)
    _stored.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release_native_memory(spark: SparkSession) -> bool:
    """Has the driver's JVM give back what it freed outside its heap. Returns whether it could.

    Each plan is compiled and sent by threads of its own, in whose allocator's pools the freed memory stays: they grow with
    every stored table of a long job. The call takes milliseconds; a JVM without the command goes on as it is.
    """
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    try:
        of = jvm.java.lang.Class.forName
        kinds = gateway.new_array(jvm.java.lang.Class, 4)
        for i, k in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = of(k)
        given = gateway.new_array(jvm.java.lang.Object, 4)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by the interface's method, because the server's own class is not open
        of("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Exception:  # noqa: BLE001  another kind or an older version of the JVM
        return False
    return True


def discard_stored() -> int:
    """Removes the files of every stored table of this process; call it when results are written. Returns their number."""
    n = len(_stored)
    while _stored:
        spark, path = _stored.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session is gone, and its files with the folder's owner
            continue
    return n


def shipped_file(spark: SparkSession, write: Callable) -> str:
    """The name by which ``SparkFiles`` has, on every executor, the file that ``write`` fills.

    It goes over the driver's disk, not its memory. It stays to the end of the process, because executors that start later get it too.
    """
    folder = tempfile.mkdtemp(prefix="tierlens-files-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = uuid.uuid4().hex
    with open(f"{folder}/{name}", "wb") as f:
        write(f)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor costs one read, not a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def maybe_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only where the counted size is inside the bound; a shuffle join beyond it."""
    return F.broadcast(df) if rows <= limit else df


def map_arrow(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with the schema as DDL; ``fn`` takes and gives iterators of record batches."""
    return df.mapInArrow(fn, schema)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salt_by: str | Column, how: str, salts: int = SALTS) -> DataFrame:
    """Equi-join whose hot keys are split ``salts`` ways: the small side is replicated, the big side salted by a column.

    ``how`` may be ``inner``, ``left``, ``left_semi`` or ``left_anti`` with ``big`` on the left. Null keys never match.
    """
    spread = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], salt_by: str | Column, how: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join of any number of rows with a table of one row a key: by broadcast where the table's counted rows
    are inside ``limit``, else salted. ``small`` should be stored, for it is counted first.
    """
    if small.limit(limit + 1).count() <= limit:
        return big.join(F.broadcast(small), keys, how)
    return salted_join(big, small, keys, salt_by, how)


def weighted_join(big: DataFrame, small: DataFrame, keys: list[str], weight: str, salt_by: str | Column, how: str, salts: int = SALTS) -> DataFrame:
    """Equi-join that splits hot keys alone. ``small`` has one row a key, whose rows in ``big`` its ``weight`` counts.

    A key with more than HOT_SHARE of all weight is hot: there are 1 / HOT_SHARE of them at most, so that their
    table may be broadcast at any size. ``how`` is as in ``salted_join``.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = small.where(F.col(weight) > total * HOT_SHARE).select(*keys).withColumn("_salts", F.lit(salts))
    some = lambda c: F.coalesce(c, F.lit(1))
    spread = small.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), some(F.col("_salts")) - 1))).drop("_salts")
    salted = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(salt_by), some(F.col("_salts"))).cast("int")).drop("_salts")
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")
