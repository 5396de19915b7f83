"""Which version of some stored tables readers see, and the removal of older ones.

Below ``root`` each version has a folder of its own, ``v=<version>``. ``_published`` holds
one small file for each switch, named by a running number. A file is written under another
name and then given its number, which fails if the number is taken: it appears whole or not
at all, and of two writers that want the same number, one looks again. A file system has this
by renaming without overwriting (HDFS), by hard links (local disks), or by a conditional
write (object stores whose ``create`` takes ``fs.option.create.conditional.overwrite``). On a
store without any of these, only one writer at a time is safe.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentUpdate(Exception):
    """Another version was published since the one that this work is based on was read."""


ANY = object()


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _switches(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """The numbers and paths of the switches, last first."""
    fs, log = _path(spark, f"{root}/_published")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(((int(n), f"{root}/_published/{n}") for n in names if n.isdigit()), reverse=True)


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _filled(spark: SparkSession, root: str) -> list[tuple[int, str, str]]:
    """The numbers, paths and versions of the switches that name one, last first."""
    found = ((n, path, _read(spark, path)) for n, path in _switches(spark, root))
    return [s for s in found if s[2]]


def last_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see; None before the first."""
    for _, path in _switches(spark, root):
        # Empty only if something other than ``switch`` made it.
        if version := _read(spark, path):
            return version
    return None


def current_version(spark: SparkSession, root: str) -> str:
    version = last_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing has been published below {root}")
    return version


def _take(spark: SparkSession, path: str, content: str) -> bool:
    """Makes a file of that content appear at once; false if the path is taken."""
    fs, target = _path(spark, path)
    draft = f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}"
    _, source = _path(spark, draft)
    scheme = fs.getScheme()
    if scheme not in ("file", "hdfs", "viewfs", "webhdfs"):
        builder = fs.createFile(target).overwrite(False)
        stream = builder.opt("fs.option.create.conditional.overwrite", "true").build()
        stream.write(bytearray(content.encode()))
        try:
            stream.close()  # the object appears here, if the store still has none
        except Py4JJavaError:
            if fs.exists(target):
                return False
            raise
        return True
    stream = fs.create(source, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    try:
        if scheme == "file":
            _link(spark, fs, source, target)
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()
            )
            none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            context.rename(source, target, options)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(source, False)
    return True


def _link(spark: SparkSession, fs, source, target) -> None:
    """A hard link: unlike a rename on a local disk, it never replaces a file."""
    paths = spark._jvm.java.nio.file.Paths
    names = [
        paths.get(fs.makeQualified(p).toUri().getPath(), spark._sc._gateway.new_array(spark._jvm.String, 0))
        for p in (target, source)
    ]
    spark._jvm.java.nio.file.Files.createLink(*names)


def switch(spark: SparkSession, root: str, version: str, based_on: object = ANY) -> None:
    """Makes ``version`` the one that readers see.

    With ``based_on`` that must still be the current version, and no number after its own may
    be taken, not even by a file without content. Otherwise the last writer wins.
    """
    while True:
        switches = _switches(spark, root)
        if based_on is not ANY:
            newest = _read(spark, switches[0][1]) if switches else None
            if newest != based_on:
                raise ConcurrentUpdate(f"{root}: {based_on} is no longer the current version")
        number = switches[0][0] + 1 if switches else 1
        if _take(spark, f"{root}/_published/{number:012d}", version):
            return


def _uses_path(root: str, version: str) -> str:
    return f"{root}/v={version}/_uses"


def note_uses(spark: SparkSession, root: str, version: str, uses: set[str]) -> None:
    """Notes that a version reads files of others, which must stay as long as it does."""
    if not uses:
        return
    fs, p = _path(spark, _uses_path(root, version))
    stream = fs.create(p, True)
    stream.write(bytearray("\n".join(sorted(uses)).encode()))
    stream.close()


def uses(spark: SparkSession, root: str, version: str) -> set[str]:
    path = _uses_path(root, version)
    fs, p = _path(spark, path)
    return set(_read(spark, path).split()) if fs.exists(p) else set()


def pin(spark: SparkSession, root: str, name: str, version: str) -> None:
    """Keeps a version until another one is pinned under the same name."""
    fs, p = _path(spark, f"{root}/_pinned/{name}")
    stream = fs.create(p, True)
    stream.write(bytearray(version.encode()))
    stream.close()


def pinned(spark: SparkSession, root: str) -> set[str]:
    fs, p = _path(spark, f"{root}/_pinned")
    files = [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []
    return {_read(spark, path) for path in files}


def publish_files(
    spark: SparkSession, root: str, write: Callable[[str], object]
) -> str | None:
    """Runs ``write`` on a new folder and switches to it; returns the folder.

    If ``write`` returns False, there is nothing to publish: the folder goes again, and None
    is returned. Readers of the folder before it are not disturbed, and keep it if ``write``
    fails.
    """
    version = uuid.uuid4().hex
    folder = f"{root}/v={version}"
    if write(folder) is False:
        remove(spark, folder)
        return None
    switch(spark, root, version)
    return folder


def current_folder(spark: SparkSession, root: str) -> str:
    return f"{root}/v={current_version(spark, root)}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what is in it."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _last_change(spark: SparkSession, path: str) -> int:
    """When the folder or anything in it changed last, in milliseconds."""
    fs, p = _path(spark, path)
    last = fs.getFileStatus(p).getModificationTime()
    files = fs.listFiles(p, True)
    while files.hasNext():
        last = max(last, files.next().getModificationTime())
    return last


def remove_old(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400) -> int:
    """Deletes all versions but the last ``keep`` and those changed in ``older_than`` seconds.

    What readers see always stays, and so do pinned versions and those that a kept one reads;
    switches that name no version do not count as kept ones.
    A version counts as changed when any of its files was, so a load that writes for long is
    left alone. What failed loads left behind goes too. Returns the number of versions
    deleted.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    limit = (time.time() - older_than) * 1000
    filled = _filled(spark, root)
    kept = {version for _, _, version in filled[:keep]}
    kept |= pinned(spark, root)
    kept |= {other for version in kept for other in uses(spark, root, version)}
    numbers = {n for n, _, _ in filled[:keep]}
    fs, p = _path(spark, root)
    gone = 0
    for status in fs.listStatus(p) if fs.exists(p) else []:
        name, path = status.getPath().getName(), status.getPath().toString()
        if not name.startswith("v=") or name[2:] in kept or status.getModificationTime() >= limit:
            continue
        if _last_change(spark, path) < limit:
            remove(spark, path)
            gone += 1
    last = max(numbers, default=0)
    for n, path in _switches(spark, root):
        # An empty one after the last may be a writer's that is about to fill it.
        if n not in numbers and (n < last or _last_change(spark, path) < limit):
            remove(spark, path)
    return gone
