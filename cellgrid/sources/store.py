"""Stores: one folder for the rows of many keys, with a manifest of what is stored.

A write adds a batch of files, in which rows lie in order of their key and, within it, along a space-filling curve over
tiles. It then commits a new version of the manifest, which has a row for each key and file: the batch, the file, the range
of the curve, the number of rows. Readers take the newest version, and only the files that can hold what they ask for. A
write that ends before its commit leaves the store as it was, and a plan may replace keys of the store it reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a manifest has besides the key.
MANIFEST = ["batch", "file", "z0", "z1", "n", "tile"]

#: Bits of a tile's coordinate on the curve.
BITS = 20


def curve(y: Column, x: Column) -> Column:
    """Morton order of tiles: the bits of both coordinates in turn."""
    bit = lambda c, i: F.shiftright(c.cast("bigint"), i).bitwiseAND(1)
    parts = [F.shiftleft(bit(x, i), 2 * i).bitwiseOR(F.shiftleft(bit(y, i), 2 * i + 1)) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def curve_of(y: int, x: int) -> int:
    """:func:`curve` of one tile."""
    return sum(((x >> i) & 1) << (2 * i) | ((y >> i) & 1) << (2 * i + 1) for i in range(BITS))


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


class Store:
    """Rows by ``key`` (column names) under ``path``; with ``tile``, rows have ``y, x`` and lie in tiles along the curve."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], tile: int | None = None):
        self.spark, self.path, self.key, self.tile = spark, path.rstrip("/"), list(key), tile

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Store:
        """A store that is there, with the key and tiles it was written with."""
        store = cls(spark, path, [])
        m = store.manifest()
        if m is None:
            raise ValueError(f"nothing is stored in {path}")
        store.key = [c for c in m.columns if c not in MANIFEST]
        store.tile = m.agg(F.max("tile")).first()[0]
        return store

    # ---- versions

    def versions(self) -> dict[int, str]:
        """Committed versions, and the folder of each one's manifest."""
        fs, folder = _fs(self.spark, f"{self.path}/versions")
        if not fs.exists(folder):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return {int(n.split("-", 1)[0]): n.split("-", 1)[1] for n in names if n[:1].isdigit()}

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """The manifest of a version (the newest): the key, ``batch, file, z0, z1, n, tile``; None for an empty store."""
        known = self.versions()
        if not known:
            return None
        return self.spark.read.parquet(f"{self.path}/manifest/{known[max(known) if version is None else version]}")

    def _commit(self, manifest: DataFrame, base: int) -> None:
        """Make ``manifest`` the version after ``base``. Of writers that start from one version, one succeeds."""
        name = uuid.uuid4().hex
        manifest.coalesce(1).write.parquet(f"{self.path}/manifest/{name}")
        fs, claim = _fs(self.spark, f"{self.path}/claims/{base + 1}")
        try:
            fs.create(claim, False).close()  # fails if it is there
        except Exception as e:
            raise RuntimeError(f"another write to {self.path} was faster, or ended while it committed: then call unlock()") from e
        fs.create(_fs(self.spark, f"{self.path}/versions/{base + 1}-{name}")[1], False).close()

    def unlock(self) -> None:
        """Take back the claim of a write that died while it committed. Not beside a writer."""
        fs, claim = _fs(self.spark, f"{self.path}/claims/{self.version() + 1}")
        fs.delete(claim, False)

    def version(self) -> int:
        """The newest version; 0 for an empty store."""
        return max([0, *self.versions()])

    # ---- writing

    def keys(self) -> DataFrame | None:
        """The keys that are stored."""
        m = self.manifest()
        return None if m is None else m.select(*self.key).distinct()

    def write(self, df: DataFrame, overwrite: bool = False, drop: DataFrame | None = None) -> None:
        """Store the rows of new keys; those of keys that are there replace them with ``overwrite``, and are an error without.

        ``drop`` (rows of keys) names keys that leave the store, unless ``df`` has rows of them. ``df`` may read the store.
        """
        base, old = self.version(), self.manifest()
        batch = f"b{uuid.uuid4().hex}"
        data = f"{self.path}/data/batch={batch}"
        if self.tile:
            ty, tx = (F.floor(F.col(c) / self.tile).cast("int") for c in ("y", "x"))
            df = df.withColumns({"tile_y": ty, "tile_x": tx, "z": curve(ty, tx)})
            order = [*self.key, "z"]
        else:
            df, order = df.withColumn("z", F.lit(0).cast("bigint")), self.key
        if old is not None and not overwrite:
            new_keys = df.select(*self.key).distinct()
            if found := new_keys.join(old.select(*self.key).distinct(), self.key, "left_semi").head():
                raise ValueError(f"{tuple(found)} is stored already; pass overwrite=True to replace it")
        within = [c for c in ("y", "x") if c in df.columns] if self.tile else []
        df.repartitionByRange(*order).sortWithinPartitions(*order, *within).write.parquet(data)
        back = self.spark.read.schema(df.schema).parquet(data)
        file = F.element_at(F.split(F.input_file_name(), "/"), -1)
        rows = back.select(*self.key, "z", file.alias("file")).groupBy(*self.key, "file").agg(F.min("z").alias("z0"), F.max("z").alias("z1"), F.count("*").alias("n"))
        rows = rows.withColumns({"batch": F.lit(batch), "tile": F.lit(self.tile).cast("int")})
        if old is not None:
            gone = rows.select(*self.key)
            gone = gone if drop is None else gone.unionByName(drop.select(*self.key))
            match = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"g.{k}")) for k in self.key])
            rows = rows.unionByName(old.alias("o").join(gone.distinct().alias("g"), match, "left_anti"))
        self._commit(rows, base)

    # ---- reading

    def files(self, where: Mapping[str, object] | None = None, tiles: Sequence[tuple[int, int]] | None = None) -> list[str]:
        """The files that can hold rows of the keys ``where`` names, and of the tiles."""
        m = self.manifest()
        if m is None:
            return []
        for k, v in (where or {}).items():
            m = m.where(F.col(k) == F.lit(v))
        if tiles is not None:
            places = [curve_of(*t) for t in tiles]
            m = m.where(reduce(lambda a, b: a | b, [(F.col("z0") <= p) & (F.col("z1") >= p) for p in places], F.lit(False)))
        return sorted(f"{self.path}/data/batch={r.batch}/{r.file}" for r in m.select("batch", "file").distinct().collect())

    def read(self, where: Mapping[str, object] | None = None, tiles: Sequence[tuple[int, int]] | None = None) -> DataFrame:
        """The stored rows, or those of the keys that ``where`` names and of some tiles, from the files that can hold them.

        A file may hold keys that a later batch has replaced, so rows meet the manifest by key and batch.
        """
        m = self.manifest()
        if m is None:
            raise ValueError(f"nothing is stored in {self.path}")
        files = self.files(where, tiles)
        if not files:
            files, m = self.files()[:1], m.limit(0)
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*files).withColumn("batch", F.col("batch").cast("string"))
        live = m.select(*self.key, "batch").distinct().alias("m")
        match = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}")) for k in [*self.key, "batch"]])
        rows = rows.alias("r").join(live, match, "left_semi")
        for k, v in (where or {}).items():
            rows = rows.where(F.col(k) == F.lit(v))
        if tiles is not None:
            rows = rows.where(reduce(lambda a, b: a | b, [(F.col("tile_y") == y) & (F.col("tile_x") == x) for y, x in tiles], F.lit(False)))
        return rows.drop("batch", "z", *(["tile_y", "tile_x"] if self.tile else []))

    def clean(self) -> int:
        """Delete batches and manifests that the newest version doesn't name; how many folders went. Not beside a writer or reader."""
        fs, root = _fs(self.spark, f"{self.path}/data")
        known, m = self.versions(), self.manifest()
        if m is None:
            return 0
        live = {f"batch={r.batch}" for r in m.select("batch").distinct().collect()} | {known[max(known)]}
        gone = 0
        for folder in ("data", "manifest"):
            for status in fs.listStatus(_fs(self.spark, f"{self.path}/{folder}")[1]):
                if status.getPath().getName() not in live:
                    fs.delete(status.getPath(), True)
                    gone += 1
        for version, name in known.items():
            if version != max(known):
                fs.delete(_fs(self.spark, f"{self.path}/versions/{version}-{name}")[1], False)
        return gone
