"""A table with one row per key that batches are merged into: the writes of a batch follow the batch, not the table.

Rows are dealt to splits by a hash of their key. A batch adds one layer of Parquet files to the splits that it has rows for. A
split with more than ``most_layers`` of them gets one layer for all but its first, the base, or a new base where the others
have grown to half of it; so a key is written again a number of times that grows with the logarithm of the table only. A
manifest names the layers of every split, oldest first. It is put in its place by one rename when all files are there, so
a reader sees all of a batch or nothing of it, and goes on with the files of its manifest while the next ones are written.
Files that no manifest of the last ``keep_versions`` names are removed by ``clean``.

One writer at a time; a batch that is merged again under the id of an earlier one changes nothing.
"""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

SPLIT, LAYER = "_split", "_layer"
VERSION_DIGITS = 12


class KeyedTable:
    """``path`` is any folder that Spark reads and that renames whole files (HDFS and its like, local folders).

    ``splits`` is fixed when a table begins: choose it so that a split of the grown table fits a task.
    """

    def __init__(self, spark, path, key, splits=16, most_layers=8, keep_versions=4):
        self.spark, self.path, self.key = spark, str(path).rstrip("/"), key
        self.splits, self.most_layers, self.keep_versions = splits, most_layers, keep_versions

    # Files

    def _folder(self, name):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, name):
        system, path = self._folder(name)
        return sorted(status.getPath().getName() for status in system.listStatus(path)) if system.exists(path) else []

    def versions(self):
        return [int(name.removesuffix(".json")) for name in self._names("manifests") if name.endswith(".json")]

    def manifest(self, version=None):
        """What version ``version`` (the last one) consists of: its layers by split, and the id of its batch."""
        versions = self.versions()
        if not versions:
            return {"version": 0, "batch": None, "splits": self.splits, "layers": {}}
        system, path = self._folder(f"manifests/{version or versions[-1]:0{VERSION_DIGITS}}.json")
        stream = system.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest):
        name = f"manifests/{manifest['version']:0{VERSION_DIGITS}}.json"
        system, trial = self._folder(f"{name}.new")
        _, place = self._folder(name)
        stream = system.create(trial, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not system.rename(trial, place):
            raise RuntimeError(f"{self.path}: another writer made version {manifest['version']}")

    # Rows

    def _split(self, splits):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(splits)).cast("int")

    def _layers(self, layers, schema):
        """Rows of some layers, {split: [layer, ...]}, with the place of their layer and their split."""
        found = None
        for number in sorted({layer["version"] for each in layers.values() for layer in each}):
            splits = [split for split, each in layers.items() if any(layer["version"] == number for layer in each)]
            paths = [f"{self.path}/data/{number:0{VERSION_DIGITS}}/{SPLIT}={split}" for split in splits]
            rows = self.spark.read.schema(schema).parquet(*paths).withColumn(LAYER, F.lit(number))
            found = rows if found is None else found.unionAll(rows)
        return found

    def _newest(self, rows):
        """One row per key, of its last layer."""
        newest = Window.partitionBy(self.key).orderBy(F.col(LAYER).desc())
        return rows.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_place", LAYER)

    def read(self, version=None):
        """The rows of the table, or None while it has none. Splits of a single layer are read as they are."""
        manifest = self.manifest(version)
        layers = manifest["layers"]
        if not layers:
            return None
        schema = manifest["schema"]
        single = {split: each for split, each in layers.items() if len(each) == 1}
        many = {split: each for split, each in layers.items() if len(each) > 1}
        parts = []
        if single:
            parts.append(self._layers(single, schema).drop(LAYER))
        if many:
            parts.append(self._newest(self._layers(many, schema)))
        return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])

    def merge(self, batch, batch_id=None):
        """Rows of ``batch`` replace those with the same key; rows without a key are left out. Returns rows written.

        Of several rows with one key the largest counts, by the other columns from left to right.
        """
        manifest = self.manifest()
        if batch_id is not None and manifest["batch"] is not None and batch_id <= manifest["batch"]:
            return 0
        splits, version = manifest["splits"], manifest["version"] + 1
        schema = ", ".join(f"`{name}` {kind}" for name, kind in batch.dtypes)
        if manifest["layers"] and manifest["schema"] != schema:
            raise ValueError(f"{self.path}: rows have other columns than the table")
        order = [F.col(name).desc_nulls_last() for name in batch.columns if name != self.key]
        first = Window.partitionBy(self.key).orderBy(*order or [F.lit(0)])
        rows = batch.filter(F.col(self.key) != "").withColumn("_place", F.row_number().over(first)).filter("_place = 1")
        self._write(rows.drop("_place"), splits, version)
        added = self._sizes(version, schema)
        layers = {split: list(each) for split, each in manifest["layers"].items()}
        for split, count in added.items():
            layers.setdefault(split, []).append({"version": version, "rows": count})
        written = sum(added.values())

        full = {split: self._to_merge(each) for split, each in layers.items() if split in added and len(each) > self.most_layers}
        if full:
            version += 1
            self._write(self._newest(self._layers(full, schema)), splits, version)
            sizes = self._sizes(version, schema)
            for split, merged in full.items():
                layers[split][-len(merged) :] = [{"version": version, "rows": sizes[split]}]
            written += sum(sizes.values())
        self._publish({"version": version, "batch": batch_id, "splits": splits, "schema": schema, "layers": layers})
        self.clean()
        return written

    def _to_merge(self, layers):
        """All layers of a split where the later ones have half as many rows as the base, else the later ones."""
        return layers if 2 * sum(layer["rows"] for layer in layers[1:]) >= layers[0]["rows"] or len(layers) == 2 else layers[1:]

    def _write(self, rows, splits, version):
        """One file per split. A trial of an earlier writer that did not get as far as its manifest is replaced."""
        placed = rows.withColumn(SPLIT, self._split(splits)).repartition(SPLIT)
        placed.write.mode("overwrite").partitionBy(SPLIT).parquet(f"{self.path}/data/{version:0{VERSION_DIGITS}}")

    def _sizes(self, version, schema):
        folder = f"{self.path}/data/{version:0{VERSION_DIGITS}}"
        if not any(name.startswith(f"{SPLIT}=") for name in self._names(f"data/{version:0{VERSION_DIGITS}}")):
            return {}
        rows = self.spark.read.schema(f"{schema}, {SPLIT} int").parquet(folder)
        return {str(row[SPLIT]): row["count"] for row in rows.groupBy(SPLIT).count().collect()}

    def clean(self):
        """Removes manifests before the last ``keep_versions`` and the splits of layers that no manifest left names."""
        versions = self.versions()
        kept = [self.manifest(version) for version in versions[-self.keep_versions :]]
        named = {(layer["version"], split) for one in kept for split, each in one["layers"].items() for layer in each}
        for version in versions[: -self.keep_versions]:
            self._remove(f"manifests/{version:0{VERSION_DIGITS}}.json")
        numbers = {version for version, _ in named}
        for name in self._names("data"):
            if int(name) > kept[-1]["version"]:
                continue
            if int(name) not in numbers:
                self._remove(f"data/{name}")
                continue
            for split in self._names(f"data/{name}"):
                if split.startswith(f"{SPLIT}=") and (int(name), split.removeprefix(f"{SPLIT}=")) not in named:
                    self._remove(f"data/{name}/{split}")

    def _remove(self, name):
        system, path = self._folder(name)
        system.delete(path, True)
