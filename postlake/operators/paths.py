"""Records of JSON lines as maps from dotted paths to text, in the order of the document.

A parsed VARIANT keeps the keys of an object sorted, so which of two values on one path comes last is
in the text alone. Each line is read once, in Arrow batches; its map is built in the row, so nothing
is exploded and gathered again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _no_number(text: str):
    raise ValueError(f"{text} is no JSON")


# Numbers stay as they are written.
_READ = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=_no_number).decode


def _steps(value) -> Iterator[tuple[str, object]]:
    return iter(value.items()) if isinstance(value, dict) else ((str(at), one) for at, one in enumerate(value))


def flat_map(record) -> dict[str, str | None]:
    """Paths of the scalars of a record. Of values on one path the last in the document stays; empty
    containers vanish and null is None."""
    if not isinstance(record, (dict, list)):
        return {"": _text(record)}
    found: dict[str, str | None] = {}
    open_ = [("", _steps(record))]
    while open_:
        prefix, steps = open_[-1]
        for key, value in steps:
            if isinstance(value, (dict, list)):
                open_.append((f"{prefix}{key}.", _steps(value)))
                break
            found[prefix + key] = _text(value)
        else:
            open_.pop()
    return found


def _text(value) -> str | None:
    return ("true" if value else "false") if isinstance(value, bool) else value


def records_of(document: dict) -> list:
    """The records of a line: a non-empty list under ``post``, the non-empty object there, or else the
    line itself without that key."""
    inner = document.pop("post", None)
    if isinstance(inner, list) and inner:
        return inner
    return [inner] if isinstance(inner, dict) and inner else [document]


def _document(line: str | None, strict: bool) -> dict | None:
    try:
        document = _READ(line) if line is not None else None
    except (ValueError, RecursionError):
        if strict:
            raise
        return None
    if strict and document is not None and not isinstance(document, dict):
        return {"post": [document]}
    return document if isinstance(document, dict) else None


def _strings(values: list[str | None]) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:  # half a surrogate pair has no UTF-8
        return pa.array([value and value.encode("utf-8", "replace").decode() for value in values], pa.string())


def record_maps(lines: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """``keys``, ``place`` (of the record in its line) and ``fields``, a MAP of every dotted path of a
    record to its value as text, for each record of the column ``line``; list elements by 0-based
    position, numbers as they are written. A record without a value has an empty map.

    A NULL line gives no rows. A line that holds no JSON object gives none either, or fails the job
    where ``strict``. A repeated JSON key takes its last value.
    """
    shape = ", ".join([*(f"`{key}` {lines.schema[key].dataType.simpleString()}" for key in keys), "place INT", "fields MAP<STRING, STRING>"])

    def run(batches):
        for batch in batches:
            rows, places, offsets, paths, values = [], [], [0], [], []
            for at, line in enumerate(batch.column("line").to_pylist()):
                document = _document(line, strict)
                for place, record in enumerate(records_of(document) if document is not None else ()):
                    found = flat_map(record)
                    rows.append(at)
                    places.append(place)
                    paths.extend(found)
                    values.extend(found.values())
                    offsets.append(len(paths))
            kept = batch.take(pa.array(rows, pa.int64()))
            fields = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), _strings(paths), _strings(values))
            columns = {key: kept.column(key) for key in keys}
            yield pa.record_batch({**columns, "place": pa.array(places, pa.int32()), "fields": fields})

    return lines.select(*keys, "line").mapInArrow(run, shape)


def path_rows(maps: DataFrame) -> DataFrame:
    """(path, value) rows of the maps, beside their other columns."""
    others = [c for c in maps.columns if c != "fields"]
    return maps.select(*others, F.explode("fields").alias("path", "value"))
