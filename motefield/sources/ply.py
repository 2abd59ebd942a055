"""Binary splat files as a Spark data source: PLY in and out, 32-byte viewer records out.

Reading: the schema comes from one header; files are cut into byte ranges, and a
task takes the fixed-width records that start inside its range, so one large
file is read by many tasks.  Writing: each task streams its rows, sorted by file,
into hidden files.  The commit writes one log that names them all and only then renames
them, so a job shows whole or not at all: before the log nothing of it is read, and from
then on the scans read what is not yet renamed under its final name.  Whoever commits
next to the same folder finishes the renames, as ``recover`` does.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField,
                               StructType)

# fixed values: property types of the format
TYPES = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "<i2", "int16": "<i2", "ushort": "<u2",
         "uint16": "<u2", "int": "<i4", "int32": "<i4", "uint": "<u4", "uint32": "<u4", "float": "<f4", "float32": "<f4",
         "double": "<f8", "float64": "<f8"}
_SPARK = {"i1": ByteType(), "u1": ShortType(), "<i2": ShortType(), "<u2": IntegerType(), "<i4": IntegerType(),
          "<u4": LongType(), "<f4": FloatType(), "<f8": DoubleType()}
_CHUNK = 64 * 1024 * 1024
_HEADER = 4096


@dataclass
class ByteRange(InputPartition):
    path: str
    place: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    moves: list


def _filesystem(path: str):
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """The path in the session's default file system, unless it names one itself."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


_LOGS = "_pending"


def _logged(system, log: str) -> list[tuple[str, str]]:
    """(hidden, final) paths of a log; none if the job was finished meanwhile."""
    try:
        with system.open_input_stream(log) as stream:
            moves = json.loads(stream.read())
    except FileNotFoundError:
        return []
    base = os.path.dirname(os.path.dirname(log))
    return [(f"{base}/{a}", f"{base}/{b}") for a, b in moves]


def _logs_in(system, base: str) -> list[str]:
    from pyarrow import fs
    found = system.get_file_info(fs.FileSelector(f"{base}/{_LOGS}", allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith("."))


def _pending(system, base: str, below: list[str]) -> dict[str, str]:
    """Final path to hidden one for committed files whose rename is open.

    Logs lie in the folder that was written to: the one read, one above, or one ``below``.
    """
    logs, folder = list(below), base.rstrip("/")
    while folder:
        logs += _logs_in(system, folder)
        folder = folder.rpartition("/")[0]
    ordered = sorted(set(logs), key=os.path.basename)
    return {final: hidden for log in ordered for hidden, final in _logged(system, log)}


def _files(path: str, recursive: bool, suffix: str) -> list[tuple[str, int, str]]:
    """(name, bytes, place) of every file that a finished commit put below ``path``."""
    from pyarrow import fs
    system, base = _filesystem(path)
    prefix = path[: len(path) - len(base)] if path.endswith(base) else ""
    info = system.get_file_info(base)
    if info.type != fs.FileType.Directory:
        hidden = _pending(system, base, []).get(base)
        there = system.get_file_info(hidden) if hidden else info
        if there.type == fs.FileType.File:
            return [(path, there.size, prefix + hidden if hidden else path)]
        return [(path, info.size, path)] if info.type == fs.FileType.File else []
    found = [f for f in system.get_file_info(fs.FileSelector(base, recursive=recursive)) if f.type == fs.FileType.File]
    sizes = {f.path: f.size for f in found}
    logs = [f.path for f in found if f"/{_LOGS}/" in f.path and not f.base_name.startswith(".")]
    places = {f.path: f.path for f in found if f.base_name.endswith(suffix) and not f.base_name.startswith(("_", "."))}
    places.update({final: hidden for final, hidden in _pending(system, base, logs).items()
                   if hidden in sizes and final.endswith(suffix)})
    return sorted((prefix + final, sizes[place], prefix + place) for final, place in places.items())


def _open(place: str, name: str):
    """The file where the listing found it, or under its name if it was renamed since."""
    system, path = _filesystem(place)
    try:
        return system.open_input_file(path)
    except FileNotFoundError:
        return system.open_input_file(_filesystem(name)[1])


def _finish(system, log: str) -> None:
    """Rename what a log names and remove it; steps that are done already are passed over."""
    for hidden, final in _logged(system, log):
        try:
            system.move(hidden, final)
        except FileNotFoundError:
            pass
    _remove(system, log)


def _remove(system, path: str) -> None:
    try:
        system.delete_file(path)
    except FileNotFoundError:
        pass


def recover(spark: SparkSession, path: str) -> int:
    """Finish commits to the folder that died between their log and their last rename; returns how many."""
    system, base = _filesystem(qualified(spark, path))
    logs = _logs_in(system, base.rstrip("/"))
    for log in logs:
        _finish(system, log)
    return len(logs)


def _read_header(stream) -> tuple[list[tuple[str, str]], int, int]:
    """Properties of the vertex element, number of vertices and where the records begin."""
    raw = b""
    while b"end_header" not in raw:
        more = stream.read(_HEADER)
        if not more:
            raise ValueError("no PLY header")
        raw += more
    end = raw.index(b"end_header") + len(b"end_header")
    while raw[end - 1:end] != b"\n":
        if end >= len(raw):
            raw += stream.read(1)
        end += 1
    lines = raw[:end].decode("ascii").split("\n")
    if not any(x.startswith("format binary_little_endian") for x in lines):
        raise ValueError("only binary little-endian files are read")
    props, count, inside = [], 0, False
    for x in lines:
        word = x.split()
        if word[:1] == ["element"]:
            inside = word[1] == "vertex"
            count = int(word[2]) if inside else count
        elif word[:1] == ["property"] and inside:
            props.append((word[2], TYPES[word[1]]))
    return props, count, end


def _properties(place: str, name: str) -> list[tuple[str, str]]:
    with _open(place, name) as stream:
        return _read_header(stream)[0]


def _united(found: list[tuple[int, int, str, str]]) -> StructType:
    """One schema for (file number, place, name, type) of all headers; a name must have one type."""
    kinds: dict[str, str] = {}
    for _, _, name, kind in sorted(found):
        if kinds.setdefault(name, kind) != kind:
            raise ValueError(f"property {name} is {kinds[name]} in one file and {kind} in another")
    return StructType([StructField(n, _SPARK[t]) for n, t in kinds.items()]
                      + [StructField("file", StringType()), StructField("row_no", LongType())])


class SplatReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options["path"]
        self.recursive = str(options.get("recursiveFileLookup", "false")).lower() == "true"
        self.columns = [(f.name, f.dataType.simpleString()) for f in schema.fields]

    def partitions(self):
        return [ByteRange(p, place, a, min(a + _CHUNK, size)) for p, size, place in _files(self.path, self.recursive, ".ply")
                for a in range(0, max(size, 1), _CHUNK)]

    def read(self, part):
        import numpy as np
        with _open(part.place, part.path) as stream:
            props, count, body = _read_header(stream)
            kind = np.dtype(props)
            first = max(0, -(-(part.start - body) // kind.itemsize))
            last = min(count, max(0, -(-(part.end - body) // kind.itemsize)))
            step = max(1, (4 << 20) // kind.itemsize)
            for at in range(first, last, step):
                n = min(step, last - at)
                stream.seek(body + at * kind.itemsize)
                rows = np.frombuffer(stream.read(n * kind.itemsize), dtype=kind)
                yield self._batch(rows, part.path, at)

    def _batch(self, rows, path, at):
        import numpy as np
        arrow = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(),
                 "double": pa.float64(), "string": pa.string()}
        data = []
        for name, kind in self.columns:
            if name == "file":
                data.append(pa.array([path] * len(rows), pa.string()))
            elif name == "row_no":
                data.append(pa.array(np.arange(at, at + len(rows), dtype="i8")))
            elif name in rows.dtype.names:
                data.append(pa.array(np.ascontiguousarray(rows[name])).cast(arrow[kind]))
            else:
                data.append(pa.nulls(len(rows), arrow[kind]))
        return pa.RecordBatch.from_arrays(data, names=[n for n, _ in self.columns])


class SplatWriter(DataSourceArrowWriter):
    """Streams rows sorted by ``file`` into one output per value of it."""

    def __init__(self, options, schema, record):
        self.path, self.record = options["path"], record
        self.columns = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name != "file"]
        self.job = f"{time.time_ns():020d}-{uuid.uuid4().hex}"

    def _header(self, n: int) -> bytes:
        if self.record == "viewer":
            return b""
        kinds = {"tinyint": "char", "smallint": "short", "int": "int", "float": "float", "double": "double", "bigint": "int"}
        lines = ["ply", "format binary_little_endian 1.0", f"element vertex {n}"]
        lines += [f"property {kinds[t]} {c}" for c, t in self.columns]
        room = 24 - len(str(n))            # keeps the length, so the count can be filled in at the end
        return ("\n".join([*lines, "comment " + "." * room, "end_header"]) + "\n").encode("ascii")

    def _encode(self, batch) -> bytes:
        import numpy as np
        if self.record == "viewer":
            kind = np.dtype([("p", "<f4", 3), ("s", "<f4", 3), ("c", "u1", 4), ("q", "u1", 4)])
            groups = {"p": ["x", "y", "z"], "s": ["sx", "sy", "sz"], "c": ["c_r", "c_g", "c_b", "c_a"], "q": ["q_w", "q_x", "q_y", "q_z"]}
            out = np.empty(batch.num_rows, kind)
            for field, names in groups.items():
                for i, n in enumerate(names):
                    out[field][:, i] = batch.column(n).to_numpy(zero_copy_only=False)
            return out.tobytes()
        kinds = {"tinyint": "i1", "smallint": "<i2", "int": "<i4", "bigint": "<i4", "float": "<f4", "double": "<f8"}
        out = np.empty(batch.num_rows, np.dtype([(c, kinds[t]) for c, t in self.columns]))
        for c, _ in self.columns:
            values = batch.column(c)
            if values.null_count and pa.types.is_integer(values.type):
                raise ValueError(f"column {c} holds nulls, which the format has no integer for")
            values = values.to_numpy(zero_copy_only=False)
            if values.dtype == np.int64 and len(values) and not (-2 ** 31 <= values.min() and values.max() < 2 ** 31):
                raise OverflowError(f"column {c} holds integers beyond 32 bits, which the format cannot hold")
            out[c] = values
        return out.tobytes()

    def write(self, batches):
        import pyarrow.compute as pc
        system, base = _filesystem(self.path)
        moves, current, stream, rows, body = [], None, None, 0, None

        def close():
            if stream is None:
                return
            stream.close()
            hidden, final = moves[-1]
            if self.record != "viewer":
                with system.open_input_stream(body) as src, system.open_output_stream(hidden) as dst:
                    dst.write(self._header(rows))
                    while chunk := src.read(8 << 20):
                        dst.write(chunk)
                system.delete_file(body)

        for batch in batches:
            names = batch.column(batch.schema.get_field_index("file"))
            ends = pc.run_end_encode(names)
            at = 0
            for stop, name in zip(ends.run_ends.to_pylist(), ends.values.to_pylist()):
                if name != current:
                    close()
                    current, rows = name, 0
                    final = f"{base}/{name}"
                    folder, leaf = os.path.split(final)
                    system.create_dir(folder, recursive=True)
                    hidden = f"{folder}/._{leaf}.{self.job}.{uuid.uuid4().hex}"
                    moves.append((hidden, final))
                    body = hidden + ".body" if self.record != "viewer" else hidden
                    stream = system.open_output_stream(body)
                part = batch.slice(at, stop - at)
                stream.write(self._encode(part))
                rows += stop - at
                at = stop
        close()
        return Written(moves)

    def _log(self, base: str) -> str:
        return f"{base.rstrip('/')}/{_LOGS}/{self.job}.json"

    def commit(self, messages):
        system, base = _filesystem(self.path)
        base = base.rstrip("/")
        for older in _logs_in(system, base):
            _finish(system, older)
        moves = [(hidden, final) for m in messages for hidden, final in (m.moves if m else [])]
        log = self._log(base)
        folder, leaf = os.path.split(log)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/.{leaf}") as out:
            out.write(json.dumps([(a[len(base) + 1:], b[len(base) + 1:]) for a, b in moves]).encode())
        system.move(f"{folder}/.{leaf}", log)          # the moment of the commit
        _finish(system, log)
        self._sweep(system, {os.path.dirname(final) for _, final in moves})

    def _sweep(self, system, folders) -> None:
        """Hidden files of attempts that were lost or repeated, in the folders the job wrote to."""
        from pyarrow import fs
        for folder in folders:
            for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if f.base_name.startswith("._") and self.job in f.base_name:
                    _remove(system, f.path)

    def abort(self, messages):
        """Take back what was written, unless the log is there: then the job counts, and is finished."""
        from pyarrow import fs
        system, base = _filesystem(self.path)
        log = self._log(base)
        if system.get_file_info(log).type == fs.FileType.File:
            _finish(system, log)
            return
        for m in messages:
            for hidden, _final in (m.moves if m else []):
                _remove(system, hidden)


class PlySource(DataSource):
    """``spark.read.format("splat_ply")``: every vertex property, plus ``file`` and ``row_no``."""

    @classmethod
    def name(cls):
        return "splat_ply"

    def schema(self):
        """The union of all headers; ``read_ply`` finds it in tasks and passes it in."""
        recursive = str(self.options.get("recursiveFileLookup", "false")).lower() == "true"
        found = [(i, j, n, t) for i, (p, _, place) in enumerate(_files(self.options["path"], recursive, ".ply"))
                 for j, (n, t) in enumerate(_properties(place, p))]
        return _united(found)

    def reader(self, schema):
        return SplatReader(self.options, schema)

    def writer(self, schema, overwrite):
        return SplatWriter(self.options, schema, "ply")


class ViewerSource(DataSource):
    """``df.write.format("splat_viewer")``: 32-byte records for viewers."""

    @classmethod
    def name(cls):
        return "splat_viewer"

    def writer(self, schema, overwrite):
        return SplatWriter(self.options, schema, "viewer")


def register(spark: SparkSession) -> None:
    """Make both formats known; the code travels with the job."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PlySource)
    spark.dataSource.register(ViewerSource)


def read_ply(spark: SparkSession, path: str, recursive: bool = False, schema: StructType | None = None) -> DataFrame:
    """Rows of every file; without a schema, the union of all headers (absent properties are null)."""
    register(spark)
    path = qualified(spark, path)
    reader = spark.read.format("splat_ply").option("recursiveFileLookup", str(recursive).lower())
    return reader.schema(schema or union_schema(spark, path, recursive)).load(path)


def union_schema(spark: SparkSession, path: str, recursive: bool = False) -> StructType:
    """Headers are read in tasks; what comes back is each property once, however many files there are."""
    files = [(place, p) for p, _, place in _files(path, recursive, ".ply")]
    if not files:
        raise FileNotFoundError(f"no PLY file in {path}")
    listed = spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "i int, place string, file string").repartition(min(len(files), 200))

    def headers(batches):
        for b in batches:
            rows = [(i, j, n, t) for i, at, f in zip(*[b.column(c).to_pylist() for c in ("i", "place", "file")])
                    for j, (n, t) in enumerate(_properties(at, f))]
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.string()))], names=["i", "j", "n", "t"])

    found = listed.mapInArrow(headers, "i int, j int, n string, t string").groupBy("n", "t").agg(F.min(F.struct("i", "j")).alias("at"))
    return _united([(r.at.i, r.at.j, r.n, r.t) for r in found.collect()])


ROWS_PER_FILE = 20_000_000


def _named(df: DataFrame, name, suffix: str, ids: list[str], rows_per_file: int) -> DataFrame:
    """Adds ``file``; names with very many rows get numbered parts, so no task writes a whole hot object."""
    from ..staging import attach
    out = df.withColumn("_name", name)
    sizes = out.groupBy("_name").agg(F.count("*").alias("_n"))
    out = attach(out, sizes, ["_name"], "_n")
    parts = F.ceil(F.col("_n") / rows_per_file)
    part = F.pmod(F.xxhash64(*ids), parts)
    out = out.withColumn("file", F.when(parts <= 1, F.concat("_name", F.lit(suffix))).otherwise(
        F.concat("_name", F.lit(".part-"), F.lpad(part.cast("string"), 5, "0"), F.lit(suffix)))).drop("_name", "_n")
    return out.repartition("file").sortWithinPartitions("file")


def write_ply(df: DataFrame, path: str, name, columns: list[str], ids: list[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """All given columns of the rows, one file per value of ``name``."""
    register(df.sparkSession)
    out = _named(df, name, ".ply", ids, rows_per_file).select(*columns, "file")
    out.write.format("splat_ply").mode("append").save(qualified(df.sparkSession, path))


def write_viewer(df: DataFrame, path: str, name, ids: list[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Position, linear scale, colour and rotation as 32-byte records."""
    from ..operators.attributes import encoded, fill_defaults, linear_scales
    register(df.sparkSession)
    out = encoded(linear_scales(fill_defaults(df)))
    cols = ["x", "y", "z", "sx", "sy", "sz", "c_r", "c_g", "c_b", "c_a", "q_w", "q_x", "q_y", "q_z"]
    _named(out, name, ".splat", ids, rows_per_file).select(*cols, "file").write.format("splat_viewer").mode("append").save(
        qualified(df.sparkSession, path))


def convert_tree(spark: SparkSession, source: str, target: str, recursive: bool = False) -> DataFrame:
    """Convert every PLY under a folder; returns the rows per file."""
    df = read_ply(spark, source, recursive)
    base = _filesystem(qualified(spark, source))[1].rstrip("/") + "/"
    stem = F.regexp_replace(F.substring_index(F.col("file"), base, -1), r"(\.part-\d{5,})?\.ply$", "")
    write_viewer(df.withColumn("_stem", stem).drop("file"), target, F.col("_stem"), ["_stem", "row_no"])
    return df.select(stem.alias("name")).groupBy("name").agg(F.count("*").alias("n_splats"))
