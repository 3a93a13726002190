"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Timestamps are read and written in the session's zone. Generated methods over
# 8000 bytes of code are never compiled by the JVM, so a wide table is better
# served by projections that Spark splits into several methods.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Applies the settings every conversion here is meant to run with."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "loadmason", cores: str = "*", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a
    temporary folder of its own, remembered in the session.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("loadmason.work.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="loadmason-")
    spark.conf.set("loadmason.work.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/loadmason/{label}-{uuid.uuid4().hex}"


def own_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A session with the caller's settings and some of its own, so that the caller's never change."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            other.conf.set(key, value)
    for key, value in conf.items():
        other.conf.set(key.replace("__", "."), value)
    other.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return other


def ship() -> None:
    """Has this package's code sent along with what Python workers run, so that it
    need not be installed on them."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


def _hadoop(spark: SparkSession, path: str, encoded: bool = False):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Removes a folder this library wrote, on whatever file system holds it; ``encoded`` if its name is a URI."""
    hadoop_path, files = _hadoop(spark, path, encoded)
    files.delete(hadoop_path, True)


def mark(spark: SparkSession, path: str) -> None:
    """Makes an empty file."""
    hadoop_path, files = _hadoop(spark, path)
    files.create(hadoop_path, True).close()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = _hadoop(spark, path)
    return files.exists(hadoop_path)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, files = _hadoop(spark, path)
    files.mkdirs(hadoop_path)


def is_marked(spark: SparkSession, path: str) -> bool:
    return exists(spark, path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    hadoop_path, files = _hadoop(spark, path)
    if not files.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in files.listStatus(hadoop_path)]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder that readers see, relative to it."""
    hadoop_path, files = _hadoop(spark, path)
    if not files.exists(hadoop_path):
        return []
    base, out, folders = files.makeQualified(hadoop_path).toString() + "/", [], [hadoop_path]
    # not listFiles, which asks a local disk for the owner of each file by a process of its own
    while folders:
        for status in files.listStatus(folders.pop()):
            path = status.getPath()
            if status.isDirectory():
                folders.append(path)
                continue
            name = path.toString().removeprefix(base)
            if not any(part.startswith(("_", ".")) and "=" not in part for part in name.split("/")):
                out.append(name)
    return out


def move_files(spark: SparkSession, moves: Sequence[tuple[str, str]], movers: int) -> None:
    """Moves files, except those that an earlier attempt has; what all have in common is asked for once."""
    if not moves:
        return
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    _, files = _hadoop(spark, moves[0][0])
    for folder in {goal.rpartition("/")[0] for _, goal in moves}:
        files.mkdirs(path_of(folder))

    def move(pair: tuple[str, str]) -> None:
        source, goal = path_of(pair[0]), path_of(pair[1])
        problem = None
        try:
            if files.rename(source, goal):
                return
        except Py4JJavaError as error:
            problem = error
        if not files.exists(goal):
            raise OSError(f"{pair[0]} could not be moved to {pair[1]}") from problem

    with ThreadPoolExecutor(movers) as pool:
        list(pool.map(move, moves))


def drop_file(spark: SparkSession, path: str, encoded: bool = False) -> None:
    hadoop_path, files = _hadoop(spark, path, encoded)
    files.delete(hadoop_path, False)


def drop_empty(spark: SparkSession, path: str, encoded: bool = False) -> bool:
    """Removes a folder if nothing but empty folders is in it."""
    hadoop_path, files = _hadoop(spark, path, encoded)
    if not files.exists(hadoop_path):
        return True
    if files.listFiles(hadoop_path, True).hasNext():
        return False
    return files.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, files = _hadoop(spark, path)
    stream = files.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_whole(spark: SparkSession, path: str, text: str, draft: str) -> bool:
    """Makes a file with this text in one step; says False if there is one of that name."""
    jvm = spark.sparkContext._jvm
    draft_path, files = _hadoop(spark, draft)
    stream = files.create(draft_path, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    goal, _ = _hadoop(spark, path)
    try:
        if files.getScheme() == "file":
            # a second name for the file: the only step on a local disk that fails if the name is taken
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (goal, draft_path)]
            jvm.java.nio.file.Files.createLink(*local)
            return True
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(goal.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(draft_path, goal, none)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        files.delete(draft_path, False)
