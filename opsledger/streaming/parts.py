"""Tables that a stream adds to: one part per micro-batch, merged in tiers.

A manifest lists the live parts; a reader sees those of one manifest and nothing else. Each micro-batch
writes its part and then a new manifest, which becomes visible by one rename. When
``fan_in`` parts of a level have gathered, they are merged into one of the next level, and a
new manifest names it in their place. So a table of n micro-batches has at most ``fan_in - 1`` parts on
each of log(n) levels, and each row is written again once per level.

A micro-batch that is replayed is known by its number and changes nothing, also while its part is
being merged: parts and merges that no manifest names do not count and are written
over. Parts that were merged stay for ``KEEP`` more manifests, for readers under way. A checkpoint that
starts anew replaces the table, because its stream reads its input from the start.

One stream writes a table. The rename must be atomic, as on HDFS and local disks.
"""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsledger.sinks.tables import run_of

FAN_IN = 8
KEEP = 10


class Parts:
    """The parts of one stream's table under ``path``; ``merge`` makes rows of several parts one part's."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        checkpoint: str,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        fan_in: int = FAN_IN,
    ):
        if fan_in < 2:
            raise ValueError("a merge takes at least two parts")
        self.spark, self.checkpoint = spark, checkpoint.rstrip("/")
        self.folder = f"{path.rstrip('/')}/run={run_of(checkpoint)}"
        self.merge, self.fan_in = merge, fan_in

    def live(self) -> list[dict]:
        """The parts of the newest manifest, in order of their micro-batches."""
        return self._manifest()["parts"]

    def read(self, parts: list[dict] | None = None) -> DataFrame:
        """The rows of the live parts; several may hold rows of one key, as ``merge`` would find them."""
        parts = self.live() if parts is None else parts
        if not parts:
            raise FileNotFoundError(f"no part is stored under {self.folder}")
        return self.spark.read.parquet(*[f"{self.folder}/{p['name']}" for p in parts])

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store a micro-batch, unless it is known already, and merge what has gathered."""
        manifest, stream = self._manifest(), self._stream()
        if manifest["stream"] != stream:
            retired = manifest["retired"] + [[p["name"], manifest["version"]] for p in manifest["parts"]]
            manifest = {"version": manifest["version"], "stream": stream, "parts": [], "retired": retired}
        if not any(p["first"] <= batch_id <= p["last"] for p in manifest["parts"]):
            part = {"name": self._name(manifest, 0, batch_id, batch_id), "level": 0, "first": batch_id, "last": batch_id}
            part["note"] = self.write(rows, f"{self.folder}/{part['name']}")
            manifest = self._switch(manifest, [*manifest["parts"], part], [])
        while (chosen := self._crowded(manifest["parts"])) is not None:
            manifest = self._merged(manifest, chosen)

    def write(self, rows: DataFrame, folder: str) -> dict | None:
        """Write a part, over what an attempt that failed has left; the manifest keeps what is returned."""
        rows.hint("rebalance").write.mode("overwrite").parquet(folder)

    def _crowded(self, parts: list[dict]) -> list[dict] | None:
        for level in sorted({p["level"] for p in parts}):
            same = [p for p in parts if p["level"] == level]
            if len(same) >= self.fan_in:
                return same[: self.fan_in]
        return None

    def _merged(self, manifest: dict, chosen: list[dict]) -> dict:
        first, last, level = chosen[0]["first"], chosen[-1]["last"], chosen[0]["level"] + 1
        part = {"name": self._name(manifest, level, first, last), "level": level, "first": first, "last": last}
        rows = self.read(chosen)
        rows = self.merge(rows) if self.merge else rows
        part["note"] = self.write(rows, f"{self.folder}/{part['name']}")
        at = manifest["parts"].index(chosen[0])
        parts = [p for p in manifest["parts"] if p not in chosen]
        return self._switch(manifest, [*parts[:at], part, *parts[at:]], [p["name"] for p in chosen])

    def _name(self, manifest: dict, level: int, first: int, last: int) -> str:
        return f"parts/{manifest['stream'][:8]}-{level}-{first}-{last}"

    def _stream(self) -> str:
        """The id that Spark gives a stream with its checkpoint; another one for a fresh checkpoint."""
        return json.loads(self._text(f"{self.checkpoint}/metadata") or '{"id": ""}')["id"]

    def _manifest(self) -> dict:
        names = sorted(n for n in self._names("manifest") if n.endswith(".json"))
        if not names:
            return {"version": 0, "stream": None, "parts": [], "retired": []}
        return json.loads(self._text(f"{self.folder}/manifest/{names[-1]}"))

    def _switch(self, manifest: dict, parts: list[dict], retired: list[str]) -> dict:
        """Make ``parts`` the live ones, and delete what no reader can still need."""
        version = manifest["version"] + 1
        held = manifest["retired"] + [[name, version] for name in retired]
        old = [name for name, since in held if since <= version - KEEP]
        new = {"version": version, "stream": manifest["stream"], "parts": parts}
        new["retired"] = [[name, since] for name, since in held if since > version - KEEP]
        file = f"{self.folder}/manifest/{version:012}.json"
        fs, path = self._fs(f"{file}.tmp")
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        if not fs.rename(path, self._path(file)):
            raise RuntimeError(f"another writer has stored {file}")
        for name in old:
            fs.delete(self._path(f"{self.folder}/{name}"), True)
        if version > KEEP:
            fs.delete(self._path(f"{self.folder}/manifest/{version - KEEP:012}.json"), False)
        return new

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, text: str):
        path = self._path(text)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(f"{self.folder}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _text(self, file: str) -> str:
        fs, path = self._fs(file)
        if not fs.exists(path):
            return ""
        stream = fs.open(path)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
