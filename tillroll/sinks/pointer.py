"""Results that are replaced whole: written beside each other, found through a pointer.

A pointer is a folder of small numbered JSON files; the one of the highest number
says what is valid now. A new file is written under another name and renamed to
a name that did not exist, which shows it whole or not at all, also where a
rename copies. So a reader finds the old result until the new one is complete,
and a writer that stops at any point leaves the old one in force.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any, NamedTuple

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

POINTER = "_current"
KEPT = 2  # results that are left in place: the valid one, and the one before for readers that have begun


class Pointed(NamedTuple):
    number: int
    content: dict[str, Any]


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none if it is not there."""
    files, place = _at(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = names_in(spark, f"{path}/{POINTER}")
    return [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit()]


def _read(spark: SparkSession, path: str, number: int) -> dict[str, Any]:
    files, place = _at(spark, f"{path}/{POINTER}/{number:020d}.json")
    stream = files.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def resolve(spark: SparkSession, path: str) -> Pointed | None:
    """What is valid under ``path``, or None before the first result."""
    numbers = _numbers(spark, path)
    return Pointed(numbers[-1], _read(spark, path, numbers[-1])) if numbers else None


def advance(spark: SparkSession, path: str, number: int, content: dict[str, Any]) -> None:
    """Make ``content`` valid; ``number`` must be above all before it. One writer at a time."""
    files, draft = _at(spark, f"{path}/{POINTER}/.draft-{uuid.uuid4().hex}")
    _, final = _at(spark, f"{path}/{POINTER}/{number:020d}.json")
    if (numbers := _numbers(spark, path)) and numbers[-1] >= number:
        raise ValueError(f"{path} is at {numbers[-1]} already, beyond {number}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if not files.rename(draft, final):
        raise OSError(f"{path} could not be moved on to {number}")


def earlier(spark: SparkSession, path: str, kept: int = KEPT) -> list[Pointed]:
    """The ``kept`` newest results, the valid one last."""
    return [Pointed(n, _read(spark, path, n)) for n in _numbers(spark, path)[-kept:]]


def forget(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Drop all pointers but the newest."""
    for number in _numbers(spark, path)[:-kept]:
        remove(spark, f"{path}/{POINTER}/{number:020d}.json")


def publish(spark: SparkSession, path: str, write: Callable[[str], Any]) -> Any:
    """Have ``write`` fill a new folder below ``path`` and make it the valid one; returns what ``write`` does.

    Folders that are neither valid nor the one before go: what a stopped writer
    has left goes with them.
    """
    valid = resolve(spark, path)
    number = valid.number + 1 if valid else 0
    folder = f"result-{number:020d}-{uuid.uuid4().hex[:8]}"
    made = write(f"{path}/{folder}")
    advance(spark, path, number, {"folder": folder})
    used = {pointed.content["folder"] for pointed in earlier(spark, path)}
    for name in names_in(spark, path):
        if name.startswith("result-") and name not in used:
            remove(spark, f"{path}/{name}")
    forget(spark, path)
    return made


def published(spark: SparkSession, path: str) -> str:
    """The folder that is valid under ``path``."""
    valid = resolve(spark, path)
    if not valid:
        raise FileNotFoundError(f"nothing has been published in {path}")
    return f"{path}/{valid.content['folder']}"
