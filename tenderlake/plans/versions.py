"""Versions of a set of tables: lists of folders, switched in one step.

A published version is a list of folders (parts). Each list is one file, named by its
place in the order of publications, and readers follow the last one. A list is written
beside the others first and then given its name, which the file system grants once only:
of two writers that built on the same version, one publishes and the other is told so. Nothing a
reader may be using is rewritten, and a folder that did not change is carried over by name, not by copy.

HDFS and the like grant a name atomically. A plain local file system looks first and renames
then, so writers of one process are kept apart by a lock.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from threading import Lock
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import PACKED, delete_path, path_exists, side_by_side

_LISTS = "publicacoes"
_LIST_SCHEMA = (
    "ordem long, publicado_em timestamp, versao string, posicao int, tabela string, periodo string, "
    "caminho string, primeira_chave long, maior_chave long, linhas long, impressao string, mudancas boolean"
)
_naming = Lock()


class Part(NamedTuple):
    """A folder of a published version.

    ``period`` is set where a table is kept by period, the keys and ``rows`` where readers or later loads
    need them, ``inputs`` is the fingerprint of what a period was made of, and ``delta`` marks rows that replace
    older ones of the same key.
    """

    table: str
    path: str
    period: str | None = None
    last_key: int | None = None
    first_key: int | None = None
    rows: int | None = None
    inputs: str | None = None
    delta: bool = False


class VersionMoved(RuntimeError):
    """Another writer published since the work began."""


ANY = object()


def new_version() -> str:
    return uuid.uuid4().hex


def version_folder(root: str, version: str) -> str:
    return f"{root}/versoes/{version}"


def version_path(root: str, version: str, table: str) -> str:
    return f"{version_folder(root, version)}/{table}"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones left out; empty if there is no such folder."""
    files, target = _files(spark, folder)
    if not files.exists(target):
        return []
    names = [s.getPath().getName() for s in files.listStatus(target)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def _orders(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in children(spark, f"{root}/{_LISTS}") if n.endswith(".json")]


def _list_path(root: str, order: int) -> str:
    return f"{root}/{_LISTS}/{order:012d}.json"


def published(spark: SparkSession, root: str) -> list:
    """Rows of the last list, one per folder, in their order."""
    orders = _orders(spark, root)
    if not orders:
        return []
    entries = spark.read.schema(_LIST_SCHEMA).json(_list_path(root, orders[-1]))
    return sorted(entries.collect(), key=lambda e: e.posicao)


def _part(entry) -> Part:
    return Part(
        entry.tabela, entry.caminho, entry.periodo, entry.maior_chave, entry.primeira_chave, entry.linhas, entry.impressao,
        bool(entry.mudancas),
    )


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version readers see: the one published last."""
    entries = published(spark, root)
    return entries[0].versao if entries else None


def current_parts(spark: SparkSession, root: str) -> list[Part]:
    return [_part(e) for e in published(spark, root) if e.caminho is not None]


def base_and_parts(spark: SparkSession, root: str) -> tuple[str | None, list[Part]]:
    """Version and folders of one and the same list, for work that builds on them."""
    entries = published(spark, root)
    return (entries[0].versao if entries else None), [_part(e) for e in entries if e.caminho is not None]


def _lines(order: int, version: str, parts: Sequence[Part]) -> str:
    now = datetime.now(timezone.utc).isoformat()
    # a version without any folder still is one, so it leaves a line
    rows = parts or [None]
    return "".join(
        json.dumps({
            "ordem": order, "publicado_em": now, "versao": version, "posicao": i,
            **({} if p is None else {
                "tabela": p.table, "periodo": p.period, "caminho": p.path, "primeira_chave": p.first_key, "maior_chave": p.last_key,
                "linhas": p.rows, "impressao": p.inputs, "mudancas": p.delta,
            }),
        }) + "\n"
        for i, p in enumerate(rows)
    )


def _name_list(spark: SparkSession, written: str, named: str) -> bool:
    """Give a written list its name; False if the name is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(written), hadoop.Path(named)
    context = hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    nothing = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        with _naming:
            context.rename(source, target, nothing)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _create_list(spark: SparkSession, root: str, order: int, version: str, parts: Sequence[Part]) -> bool:
    """Write a list and name it; False if another one got the place."""
    written = f"{version_folder(root, version)}/lista-{order}.json"
    files, target = _files(spark, written)
    out = files.create(target, True)
    try:
        out.write(bytearray(_lines(order, version, parts).encode()))
    finally:
        out.close()
    files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{_LISTS}"))
    return _name_list(spark, written, _list_path(root, order))


def publish_parts(
    spark: SparkSession, root: str, version: str, parts: Sequence[Part], base: str | None | object = ANY
) -> None:
    """Switch readers to a list of folders. One named file is the whole switch.

    A list that carries folders over from the version ``base`` is refused when another version has been
    published meanwhile, as it would take that version's changes back; without a base it comes
    after whatever was published.
    """
    while True:
        orders = _orders(spark, root)
        before = published(spark, root)
        now = before[0].versao if before else None
        if base is not ANY and base != now:
            raise VersionMoved(f"built on version {base}, but {now} is published")
        if now == version:
            raise ValueError(f"version is published already: {version}")
        if _create_list(spark, root, (orders[-1] if orders else 0) + 1, version, parts):
            return


@contextmanager
def removed_on_failure(spark: SparkSession, root: str, version: str) -> Iterator[None]:
    """Take the folders of a version away when what fills, checks or publishes them fails."""
    try:
        yield
    except BaseException:
        delete_path(spark, version_folder(root, version))
        raise


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the last ``keep`` publications uses; returns them.

    Readers of an older version lose it, so ``keep`` has to cover the longest-running query. Lists that
    were kept for these folders go with them.
    """
    orders = _orders(spark, root)
    old = orders[: -keep] if keep >= 1 else []
    if not old:
        return []
    entries = spark.read.schema(_LIST_SCHEMA).json([_list_path(root, n) for n in orders])
    entries = entries.filter("caminho is not null")
    kept = entries.filter(F.col("ordem") > old[-1]).select("caminho")
    unused = entries.select("caminho").distinct().join(kept, "caminho", "left_anti")
    folders = sorted(r.caminho for r in unused.collect() if path_exists(spark, r.caminho))
    for folder in folders:
        delete_path(spark, folder)
    for order in old:
        delete_path(spark, _list_path(root, order))
    return folders


# Sets of tables that are replaced as a whole


@contextmanager
def replaced_set(spark: SparkSession, root: str, keep: int = 2) -> Iterator[str]:
    """A new folder to write a set of tables to, one subfolder each.

    Readers see all of them once the block ends, and the set before until then. If the block fails, or the
    job dies, the set before stays. Sets older than the last ``keep`` are deleted.
    """
    version = new_version()
    folder = version_folder(root, version)
    with removed_on_failure(spark, root, version):
        yield folder
        publish_parts(spark, root, version, [Part(n, f"{folder}/{n}") for n in children(spark, folder)])
    expire_versions(spark, root, keep)


def set_path(spark: SparkSession, root: str, name: str) -> str:
    """Folder of a table in the current set."""
    for part in current_parts(spark, root):
        if part.table == name:
            return part.path
    raise FileNotFoundError(f"no table {name} below {root}")


def write_set(spark: SparkSession, tables: dict[str, DataFrame], root: str, keep: int = 2) -> None:
    """Replace a set of tables, written at the same time and as they lie: files are those of the tasks, rows are not shuffled again."""
    with replaced_set(spark, root, keep) as folder:

        def write(name: str, df: DataFrame) -> Callable[[], None]:
            return lambda: df.write.options(**PACKED).parquet(f"{folder}/{name}")

        side_by_side(spark, {name: write(name, df) for name, df in tables.items()})
