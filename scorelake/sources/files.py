"""Files below the root of a table: on a local disk by the operating system, in any other store by Spark's file systems."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

Place = Path | str


def place(path: Place) -> Place:
    """A Path for a local one, the text for one with a scheme such as hdfs: or s3a:."""
    return str(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", str(path)) else Path(path)


def local(path: Place) -> str | None:
    """The absolute path on local disks, None for a place in another store."""
    return os.path.abspath(re.sub("^file:/+", "/", str(path))) if isinstance(path, Path) or path.startswith("file:") else None


def join(root: Place, *names: str) -> Place:
    return root.joinpath(*names) if isinstance(root, Path) else "/".join((root.rstrip("/"), *names))


def parent(path: Place) -> Place:
    return path.parent if isinstance(path, Path) else path.rstrip("/").rpartition("/")[0]


def name(path: Place) -> str:
    return str(path).rstrip("/").rpartition("/")[2]


def _store(path: str) -> tuple[Any, Any, Any]:
    """File system, path and JVM."""
    spark = SparkSession.active()
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there, spark._jvm


def exists(path: Place) -> bool:
    if isinstance(path, Path):
        return path.exists()
    store, there, _ = _store(path)
    return store.exists(there)


def names(folder: Place) -> list[str]:
    """Names in a folder, none if there is no folder."""
    if isinstance(folder, Path):
        return sorted(p.name for p in folder.iterdir()) if folder.is_dir() else []
    store, there, _ = _store(folder)
    return sorted(s.getPath().getName() for s in store.listStatus(there)) if store.exists(there) else []


def text(path: Place) -> str:
    """The text of a small file."""
    if isinstance(path, Path):
        return path.read_text()
    store, there, jvm = _store(path)
    stream = store.open(there)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put(path: Place, content: str) -> None:
    """Write a small file in one step: readers see the old file or the new one."""
    fresh = join(parent(path), f".{name(path)}.{uuid.uuid4().hex}")
    if isinstance(path, Path):
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            with open(fresh, "x") as f:
                f.write(content)
                f.flush()
                os.fsync(f.fileno())
            os.replace(fresh, path)
            _sync_folder(path.parent)
        finally:
            fresh.unlink(missing_ok=True)
        return
    store, there, jvm = _store(path)
    stream = store.create(jvm.org.apache.hadoop.fs.Path(fresh), False)
    try:
        stream.write(bytearray(content.encode()))
        stream.hsync()
    finally:
        stream.close()
    _move_over(store, jvm, fresh, there)


def _move_over(store: Any, jvm: Any, fresh: str, there: Any) -> None:
    """Rename a file onto another one."""
    overwrite = SparkSession.active().sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(there.toUri(), store.getConf()).rename(jvm.org.apache.hadoop.fs.Path(fresh), there, overwrite)


def put_joined(path: Place, parts: list[Place]) -> None:
    """Write the bytes of some files one behind the other in one step, a block at a time; path may be one of them."""
    fresh = join(parent(path), f".{name(path)}.{uuid.uuid4().hex}")
    if isinstance(path, Path):
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            with open(fresh, "xb") as f:
                for part in parts:
                    with open(part, "rb") as g:
                        shutil.copyfileobj(g, f)
                f.flush()
                os.fsync(f.fileno())
            os.replace(fresh, path)
            _sync_folder(path.parent)
        finally:
            fresh.unlink(missing_ok=True)
        return
    store, there, jvm = _store(path)
    stream = store.create(jvm.org.apache.hadoop.fs.Path(fresh), False)
    try:
        for part in parts:
            source = store.open(jvm.org.apache.hadoop.fs.Path(str(part)))
            try:
                jvm.org.apache.commons.io.IOUtils.copyLarge(source, stream)
            finally:
                source.close()
        stream.hsync()
    finally:
        stream.close()
    _move_over(store, jvm, fresh, there)


def create(path: Place, content: str) -> None:
    """Write a small file that isn't there yet, whole or not at all; FileExistsError if somebody else was first.

    The store must refuse a rename onto a file that is there, as local disks (by
    a link) and HDFS do.
    """
    if isinstance(path, str) and path.startswith("file:"):
        path = Path(re.sub("^file:/+", "/", path))
    fresh = join(parent(path), f".{name(path)}.{uuid.uuid4().hex}")
    if isinstance(path, Path):
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            with open(fresh, "x") as f:
                f.write(content)
                f.flush()
                os.fsync(f.fileno())
            os.link(fresh, path)
            _sync_folder(path.parent)
        finally:
            fresh.unlink(missing_ok=True)
        return
    store, there, jvm = _store(path)
    stream = store.create(jvm.org.apache.hadoop.fs.Path(fresh), False)
    try:
        stream.write(bytearray(content.encode()))
        stream.hsync()
    finally:
        stream.close()
    none = SparkSession.active().sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(there.toUri(), store.getConf()).rename(jvm.org.apache.hadoop.fs.Path(fresh), there, none)
    except Exception as e:
        store.delete(jvm.org.apache.hadoop.fs.Path(fresh), False)
        if store.exists(there):
            raise FileExistsError(path) from e
        raise


def modified(path: Place) -> float:
    """Time of the last change, in seconds."""
    if isinstance(path, Path):
        return path.stat().st_mtime
    store, there, _ = _store(path)
    return store.getFileStatus(there).getModificationTime() / 1000


def rename(old: Place, new: Place) -> None:
    if isinstance(old, Path):
        new.parent.mkdir(parents=True, exist_ok=True)
        old.rename(new)
        return
    store, there, jvm = _store(old)
    target = jvm.org.apache.hadoop.fs.Path(str(new))
    store.mkdirs(target.getParent())
    if not store.rename(there, target):
        raise OSError(f"{old} can't be renamed to {new}")


def remove(folder: Place) -> None:
    """Delete a file, or a folder with all that is in it, if it is there."""
    if isinstance(folder, Path):
        if folder.is_dir():
            shutil.rmtree(folder, ignore_errors=True)
        else:
            folder.unlink(missing_ok=True)
        return
    store, there, _ = _store(folder)
    store.delete(there, True)


def sync(root: Place) -> None:
    """Flush all files below a local root, then their folders; other stores keep what they have closed."""
    if isinstance(root, Path):
        for folder, _, found in os.walk(root, topdown=False):
            for file in found:
                with open(Path(folder, file), "rb") as f:
                    os.fsync(f.fileno())
            _sync_folder(Path(folder))


def _sync_folder(folder: Path) -> None:
    handle = os.open(folder, os.O_RDONLY)
    try:
        os.fsync(handle)
    finally:
        os.close(handle)
