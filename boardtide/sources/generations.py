"""Tables that are replaced as a whole: immutable folders and one pointer to those that count.

    <root>/data/<table>-<unique>/        written once, never changed
    <root>/versions/<number>             one line of JSON: which folders make up each table

A version begins to count when its pointer appears, by the rename of a finished file to a name that
must not exist yet.  A run that dies before leaves the version before readable, of two runs at a
time one fails, and readers of all tables of one version never see halves of two.
"""

import json
import re
import uuid

from pyspark.sql import DataFrame

from boardtide import schema
from boardtide.sources.snapshots import _fs, delete_folder

#: Versions kept readable for those who opened them before the newest.
KEEP = 2
_NUMBER = re.compile(r"(\d{12})$")


class Conflict(RuntimeError):
    """Another run published the same version first."""


class Generations:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def _versions(self):
        fs, p = _fs(self.spark, f"{self.root}/versions")
        found = (_NUMBER.search(s.getPath().getName()) for s in (fs.listStatus(p) if fs.exists(p) else []))
        return sorted(int(hit.group(1)) for hit in found if hit)

    def _pointer(self, version):
        fs, p = _fs(self.spark, f"{self.root}/versions/{version:012d}")
        size = fs.getFileStatus(p).getLen()
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readNBytes(size)).decode())
        finally:
            stream.close()

    def current(self):
        """The newest pointer, {"version", "tables": {name: folders}, "note"}; None before the first."""
        versions = self._versions()
        return self._pointer(versions[-1]) | {"version": versions[-1]} if versions else None

    def read(self, name, layout, at=None):
        """A table of version `at`, a pointer from `current`, or of the newest; empty if there is none."""
        at = at or self.current()
        folders = at["tables"].get(name, []) if at else []
        if not folders:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(*[f"{self.root}/data/{f}" for f in folders])

    def publish(self, replace, append=None, note=None, base=None) -> int:
        """Write the tables of `replace` anew and `append` to others; both map names to DataFrames.

        Tables named in neither stay as they are.  `base` is the pointer the frames were computed
        from (default: the newest); if a newer one appears in the meantime, Conflict is raised.
        `note` goes with the version; a function is called for it once all tables are written.
        """
        base = base or self.current() or {"version": 0, "tables": {}}
        tables, written = dict(base["tables"]), []
        try:
            for name, df in {**(append or {}), **replace}.items():
                folder = f"{name}-{uuid.uuid4().hex}"
                written.append(folder)
                _write(df, f"{self.root}/data/{folder}")
                tables[name] = [folder] if name in replace else [*tables.get(name, []), folder]
            version = base["version"] + 1
            self._point(version, {"tables": tables, "note": note() if callable(note) else note})
        except BaseException:
            for folder in written:
                delete_folder(self.spark, f"{self.root}/data/{folder}")
            raise
        self._prune()
        return version

    def _point(self, version, pointer):
        fs, final = _fs(self.spark, f"{self.root}/versions/{version:012d}")
        _, draft = _fs(self.spark, f"{self.root}/drafts/{uuid.uuid4().hex}")
        fs.mkdirs(final.getParent())
        out = fs.create(draft)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        # some stores rename onto an existing file
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise Conflict(f"version {version} of {self.root} exists")

    def _prune(self):
        """Drop pointers older than KEEP versions, and folders that only they name."""
        versions = self._versions()
        kept, old = versions[-KEEP:], versions[:-KEEP]
        if not old:
            return
        used = {f for v in kept for folders in self._pointer(v)["tables"].values() for f in folders}
        named = {f for v in old for folders in self._pointer(v)["tables"].values() for f in folders}
        for v in old:
            delete_folder(self.spark, f"{self.root}/versions/{v:012d}")
        for folder in named - used:
            delete_folder(self.spark, f"{self.root}/data/{folder}")


def _write(df: DataFrame, path):
    df.write.mode("errorifexists").parquet(path)


def read_sent(spark, root):
    """The sent state last published; empty before the first run."""
    return Generations(spark, root).read("sent", schema.SENT_STATE)


def write_sent(spark, root, sent):
    return Generations(spark, root).publish({"sent": schema.conform(sent, schema.SENT_STATE)})
