"""The sharded component table, stored as Parquet under immutable manifests.

Plain Parquet has no UPDATE, and rewriting a very large table every round
would cost the whole table per round.  So the table is kept as *layers* of
rows plus a *label history* that maps every label merged away to its current
label; a round writes only a new history (its size grows with the labels
merged, not with the table), and readers resolve labels with one join.

    <path>/manifests/v=<n>.json      one file per version, never changed
    <path>/data/<kind>-<id>/         what manifests name: rows, reverse indexes,
                                     histories, states of streams
    <path>/_quarantine/              input that could not be merged

A manifest names everything that a version consists of: the settings, the
layers with the shards that count in each, the history, the states of the
streams, and the entry of the round log (one per version, ``c3`` for a round).
A writer first writes its data, then creates the next manifest by renaming a
complete file to a name that must not exist.  So a crash at any point leaves
the old version or the new one, and of two writers one gets
:class:`ConcurrentUpdate` and has changed nothing.  (The rename must be atomic,
as on HDFS; on a local disk the test for the name comes just before it.)
Readers take the newest manifest once and keep to it; :meth:`ComponentStore.at`
reads an older one.

Rows of a layer are range-partitioned and sorted by (shard, uid), with bloom
filters on the uid, so a point lookup reads one shard's files and in them the
row groups that may hold the uid.  With ``member_index`` a layer also has its
rows by (bucket of the label, label), for the members of a component.

Rounds are idempotent for uid edges, and a replayed streaming batch is
recognised by its ``source`` and ``batch_id``; loading a table anew starts a new
epoch of the round log.  Items can be added at any time; a round or an addition
rewrites no row.  :meth:`ComponentStore.compact` rewrites the shards that hold
old labels or several layers, and :meth:`ComponentStore.vacuum` deletes what no
kept version names.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import code_of_number, shard_name
from ..operators.components import connected_components
from ..operators.neighbors import successor_edges
from ..operators.table import assign_dense_ids, contract_edges, lookup_uid, relabel
from ..schemas import COMPONENT_TABLE
from ..session import (create_file, delete_path, hadoop_fs, list_dirs, list_files, materialize, path_exists,
                       read_file, release, shuffle_partitions)
from .rounds import advance_history, resolve_labels

ROUND_LOG = T.StructType([
    T.StructField("round", T.IntegerType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("n_edges", T.LongType(), False),
    T.StructField("n_unknown", T.LongType(), False),
    T.StructField("n_vertices", T.LongType(), False),
    T.StructField("n_merged", T.LongType(), False),
    T.StructField("message", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("epoch", T.IntegerType(), True),
])

HISTORY = T.StructType([
    T.StructField("old", T.LongType(), False),
    T.StructField("cur", T.LongType(), False),
])

INDEX = T.StructType([
    T.StructField("uid", T.StringType(), False),
    T.StructField("cmp", T.LongType(), False),
    T.StructField("shard", T.IntegerType(), True),
    T.StructField("bucket", T.IntegerType(), False),
])

#: Spark's name of the folder of rows whose shard is NULL.
NULL_SHARD = "__HIVE_DEFAULT_PARTITION__"
#: So many labels of one component are given to the scan as constants.
MAX_LITERALS = 1000


class UidNotUnique(ValueError):
    pass


class UidMissing(ValueError):
    pass


class ConcurrentUpdate(RuntimeError):
    """Another writer committed the version this one was about to write."""


class VersionExpired(ValueError):
    """The data of this version were deleted by ``vacuum``."""


@dataclass
class RoundResult:
    version: int           # version written by the round
    labels: DataFrame      # (id, cmp): old label -> new label, this round
    unknown: DataFrame     # edges with an end that is not stored
    skipped: bool = False
    scratch: list = field(default_factory=list)  # written inputs behind labels / unknown

    def release(self) -> None:
        """Delete the written round inputs once ``labels`` / ``unknown`` are used."""
        for df in self.scratch:
            release(df)
        self.scratch = []


class ComponentStore:
    """A component table ``(uid, cmp, mapped, shard)`` kept at ``path``.

    ``n_shards``, ``prefix``, ``uid_width``, ``shard_by`` and ``member_index``
    are settings of the table: they are stored with its first version and read
    from there; naming another value for an existing table is an error.
    ``shard_by`` is ``digit:<k>`` (the k-th character as a number; default the
    first) or ``hash`` (of the uid, over ``n_shards``).  A Python ``shard_fn``
    takes its place, but cannot be stored and must be passed whenever the
    table is opened.  ``uid_width`` is noted from the items when it is not
    given: the common length, if every uid is digits of one length.
    ``version`` pins the reader to a version.
    """

    def __init__(self, spark: SparkSession, path: str, n_shards: int | None = None,
                 prefix: str | None = None, shard_fn: Callable[[Column], Column] | None = None,
                 uid_width: int | None = None, shard_by: str | None = None,
                 member_index: bool | None = None, version: int | None = None):
        self.spark, self.path, self.version = spark, path.rstrip("/"), version
        if shard_fn and shard_by:
            raise ValueError("give shard_fn or shard_by, not both")
        if shard_by and not re.fullmatch("hash|digit:[1-9][0-9]*", shard_by):
            raise ValueError("shard_by must be 'hash' or 'digit:<k>'")
        self._shard_fn = shard_fn
        self._asked = {k: v for k, v in (("n_shards", n_shards), ("prefix", prefix), ("uid_width", uid_width),
                                         ("shard_by", shard_by), ("member_index", member_index)) if v is not None}
        m = self._manifest()
        if m:
            for k, v in self._asked.items():
                if m["settings"].get(k) != v:
                    raise ValueError(f"{path} has {k}={m['settings'].get(k)!r}, not {v!r}")

    # -- manifests ------------------------------------------------------
    def _file(self, v: int) -> str:
        return f"{self.path}/manifests/v={v}.json"

    def versions(self) -> list[int]:
        """Numbers of all versions, oldest first."""
        return sorted(int(n[2:-5]) for n in list_files(self.spark, f"{self.path}/manifests")
                      if n.startswith("v=") and n.endswith(".json"))

    def current_version(self) -> int | None:
        """The newest version (None when the table does not exist), or the
        one that this reader is pinned to."""
        if self.version is not None:
            return self.version
        vs = self.versions()
        return vs[-1] if vs else None

    def _manifest(self, version: int | None = None) -> dict | None:
        v = self.current_version() if version is None else version
        return None if v is None else json.loads(read_file(self.spark, self._file(v)))

    def _need(self) -> dict:
        m = self._manifest()
        if m is None:
            raise FileNotFoundError(f"no component table at {self.path}")
        return m

    def _new(self, m: dict | None, message: str, **changes) -> dict:
        """The manifest after ``m`` with some parts changed."""
        entry = {"round": 0, "batch_id": None, "n_edges": 0, "n_unknown": 0, "n_vertices": 0, "n_merged": 0,
                 "source": None} | changes.pop("entry", {})
        base = m or {"version": -1, "epoch": 0, "settings": self._settings(), "layers": [], "history": None,
                     "next": 0, "streams": {}, "round": 0, "batches": {}}
        out = base | {"version": base["version"] + 1} | changes
        return out | {"entry": entry | {"message": message, "version": out["version"], "epoch": out["epoch"]}}

    def _commit(self, m: dict, written: list[str]) -> int:
        """Create the manifest; the data of a lost race are deleted."""
        if self.version is not None:
            raise ValueError("this reader is pinned to a version")
        if not create_file(self.spark, self._file(m["version"]), json.dumps(m)):
            for name in written:
                delete_path(self.spark, self._data(name))
            raise ConcurrentUpdate(f"version {m['version']} of {self.path} was committed by another writer")
        return m["version"]

    def _data(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def _write(self, df: DataFrame, kind: str, partition_by: list[str] = (), **options: str) -> str:
        """Write data of a version to come; returns the name for its manifest."""
        name = f"{kind}-{uuid.uuid4().hex}"
        w = df.write.mode("errorifexists").options(**options)
        (w.partitionBy(*partition_by) if partition_by else w).parquet(self._data(name))
        return name

    # -- settings -------------------------------------------------------
    def _settings(self) -> dict:
        return {"n_shards": 10, "prefix": "connector", "uid_width": None, "shard_by": "digit:1", "member_index": True,
                "buckets": min(4096, max(16, shuffle_partitions(self.spark))),
                "custom_shard": self._shard_fn is not None, "width_given": "uid_width" in self._asked} | self._asked

    def settings(self) -> dict:
        """The stored settings (those to come for a table that isn't there)."""
        m = self._manifest()
        return m["settings"] if m else self._settings()

    @property
    def uid_width(self) -> int | None:
        return self.settings()["uid_width"]

    def shard_fn(self, uid: Column) -> Column:
        s = self.settings()
        if self._shard_fn:
            return self._shard_fn(uid)
        if s["custom_shard"]:
            raise ValueError(f"{self.path} was made with a shard_fn of its own: pass it")
        kind, _, at = s["shard_by"].partition(":")
        if kind == "hash":
            return F.pmod(F.xxhash64(uid), F.lit(s["n_shards"])).cast("int")
        return F.substring(uid, int(at), 1).try_cast("int")

    def shard_names(self) -> list[str]:
        s = self.settings()
        return [f"{s['prefix']}_{i}" for i in range(s["n_shards"])]

    def with_shard_names(self) -> DataFrame:
        return self.read().withColumn("shard_name", shard_name("shard", self.settings()["prefix"]))

    # -- reading --------------------------------------------------------
    def exists(self) -> bool:
        return self.current_version() is not None

    def at(self, version: int) -> "ComponentStore":
        """A reader of an older version."""
        if version not in self.versions():
            raise ValueError(f"{self.path} has no version {version}")
        other = ComponentStore(self.spark, self.path, shard_fn=self._shard_fn, version=version)
        names = _named(other._need())
        if any(not path_exists(self.spark, self._data(n)) for n in names):
            raise VersionExpired(f"version {version} of {self.path} was cleaned up")
        return other

    def _rows(self, m: dict, part: str) -> DataFrame:
        """The rows of all layers (``part``: 'rows' or 'index'), every one
        restricted to its shards; a replacing layer hides the rows that
        earlier layers have for its uids."""
        schema = COMPONENT_TABLE if part == "rows" else INDEX
        out = None
        for layer in m["layers"]:
            if not layer["shards"]:
                continue
            one = self.spark.read.schema(schema).parquet(self._data(layer[part]))
            known = [int(s) for s in layer["shards"] if s != NULL_SHARD]
            here = F.col("shard").isin(known)
            if NULL_SHARD in layer["shards"]:
                here = here | F.col("shard").isNull()
            # Only where some of the layer's shards no longer count.
            one = one.where(here) if len(layer["shards"]) < layer["written"] else one
            if out is not None and layer["replaces"]:
                mine = self.spark.read.schema(COMPONENT_TABLE).parquet(self._data(layer["rows"])).select("uid")
                out = out.join(mine, "uid", "left_anti")
            out = one if out is None else out.unionByName(one)
        if out is None:
            return self.spark.createDataFrame([], schema)
        return out.select(*schema.fieldNames())

    def base(self) -> DataFrame:
        """The rows with the labels that they were written with."""
        return self._rows(self._need(), "rows")

    def history(self) -> DataFrame:
        """``(old, cur)``: every label merged away, with its current label."""
        m = self._manifest()
        if not m or not m["history"]:
            return self.spark.createDataFrame([], HISTORY)
        return self.spark.read.schema(HISTORY).parquet(self._data(m["history"]))

    def _resolve(self, rows: DataFrame) -> DataFrame:
        """Current labels of some base rows (a left join on the old label)."""
        return resolve_labels(rows, self.history())

    def read(self) -> DataFrame:
        """The current table: the rows with their labels resolved through the
        history (:meth:`compact` folds the history into the rows)."""
        return self._resolve(self.base())

    def layer_of_shards(self) -> dict[int | None, str]:
        """The name of the newest rows of every shard."""
        out = {}
        for layer in self._need()["layers"]:
            out |= {None if s == NULL_SHARD else int(s): layer["rows"] for s in layer["shards"]}
        return out

    # -- layers ---------------------------------------------------------
    def _layer(self, df: DataFrame, replaces: bool = False) -> tuple[dict, list[str]]:
        """Write rows as a layer, and their reverse index if the table has one."""
        s = self.settings()
        # Range partitions split a large shard over many tasks, and every
        # file holds a narrow range of uids of few shards.
        rows = (df.select(*COMPONENT_TABLE.fieldNames()).repartitionByRange("shard", "uid")
                .sortWithinPartitions("shard", "uid"))
        name = self._write(rows, "rows", ["shard"], **_bloom("uid"))
        shards = [d.removeprefix("shard=") for d in list_dirs(self.spark, self._data(name)) if d.startswith("shard=")]
        layer = {"rows": name, "shards": sorted(shards), "written": len(shards), "replaces": replaces, "index": None}
        if s["member_index"]:
            back = self.spark.read.schema(COMPONENT_TABLE).parquet(self._data(name))
            rows = (back.select("uid", "cmp", "shard", F.pmod("cmp", F.lit(s["buckets"])).cast("int").alias("bucket"))
                    .hint("rebalance", "bucket").sortWithinPartitions("bucket", "cmp"))
            layer["index"] = self._write(rows, "index", ["bucket"])
        return layer, [n for n in (name, layer["index"]) if n]

    def _write_history(self, df: DataFrame) -> str:
        # Found by the label merged away (bloom filter) or by its current one (order).
        rows = df.select("old", "cur").repartitionByRange("cur", "old").sortWithinPartitions("cur", "old")
        return self._write(rows, "history", **_bloom("old"))

    def compact(self) -> int:
        """Fold the history into the rows.  Only shards with a label merged
        away, or with rows in several layers, are rewritten; the files of the
        others stay where they are."""
        m = self._need()
        held: dict[str, int] = {}
        for layer in m["layers"]:
            for s in layer["shards"]:
                held[s] = held.get(s, 0) + 1
        stale = {s for s, n in held.items() if n > 1}
        if m["history"]:
            old = self.history().select(F.col("old").alias("cmp"))
            found = self.base().join(old, "cmp", "left_semi").select("shard").distinct().collect()  # a row a shard
            stale |= {NULL_SHARD if r["shard"] is None else str(r["shard"]) for r in found}
        if not stale:
            if not m["history"]:
                return m["version"]
            return self._commit(self._new(m, "compact", history=None), [])
        known = [int(s) for s in stale if s != NULL_SHARD]
        here = F.col("shard").isin(known)
        if NULL_SHARD in stale:
            here = here | F.col("shard").isNull()
        layer, written = self._layer(self.read().where(here))
        layers = [x | {"shards": [s for s in x["shards"] if s not in stale]} for x in m["layers"]]
        layers = [x for x in layers if x["shards"]] + [layer]
        return self._commit(self._new(m, "compact", layers=layers, history=None), written)

    def vacuum(self, keep: int = 1, grace_seconds: float = 86400.0) -> list[str]:
        """Delete the data that only versions before the last ``keep`` name,
        and data that no version names (of failed writers) when they are older
        than ``grace_seconds``.  The manifests stay, as the round log.
        Returns the names deleted."""
        if keep < 1:
            raise ValueError("keep at least one version")
        vs = self.versions()
        used = set().union(*[_named(self._manifest(v)) for v in vs[-keep:]]) if vs else set()
        once = set().union(*[_named(self._manifest(v)) for v in vs[:-keep]]) if vs[:-keep] else set()
        p, fs = hadoop_fs(self.spark, f"{self.path}/data")
        gone = []
        for st in (fs.listStatus(p) if fs.exists(p) else []):
            name = st.getPath().getName()
            if name in used:
                continue
            if name in once or time.time() - st.getModificationTime() / 1000 > grace_seconds:
                delete_path(self.spark, self._data(name))
                gone.append(name)
        return sorted(gone)

    # -- table management ----------------------------------------------
    def create(self) -> None:
        """Create the (empty) table with its settings if it does not exist."""
        if not self.exists():
            self._commit(self._new(None, "create"), [])

    def _checked(self, uids: DataFrame, check_unique: bool) -> tuple[int, int | None]:
        """Checks uids; returns their number and their common width, if they
        are digits of one."""
        c = F.col("uid").cast("string")
        r = uids.agg(F.count_if(c.isNull()).alias("none"), F.min(F.length(c)).alias("a"), F.max(F.length(c)).alias("b"),
                     F.bool_and(c.rlike("^[0-9]{1,18}$")).alias("digits"), F.count(F.lit(1)).alias("n")).first()
        if r["none"]:
            raise UidMissing("an item has no uid")
        if check_unique:
            dup = uids.groupBy("uid").count().where(F.col("count") > 1).limit(1).collect()
            if dup:
                raise UidNotUnique(f"uid {dup[0]['uid']!r} occurs more than once")
        return r["n"], r["a"] if r["digits"] and r["a"] == r["b"] else None

    def _numbered(self, uids: DataFrame, order_by: list[str] | None, start: int) -> DataFrame:
        """Table rows for uids; numbers go on from ``start`` where none are given."""
        if "cmp" in uids.columns:
            # Numbers given (e.g. the enumerated domain): keep them, fill the rest.
            rows = uids
        else:
            rows = assign_dense_ids(uids.select("uid", *[c for c in order_by or [] if c != "uid"]),
                                    order_by or ["uid"], "cmp").withColumn("cmp", F.col("cmp") + start)
        return rows.select(
            F.col("uid").cast("string").alias("uid"), F.col("cmp").cast("bigint").alias("cmp"),
            (F.col("mapped") if "mapped" in uids.columns else F.lit(False)).alias("mapped"),
            (F.col("shard") if "shard" in uids.columns else self.shard_fn(F.col("uid"))).cast("int").alias("shard"))

    def _next(self, layer: dict, before: int) -> int:
        rows = self.spark.read.schema(COMPONENT_TABLE).parquet(self._data(layer["rows"])) if layer["written"] else None
        most = rows.agg(F.max("cmp")).first()[0] if rows is not None else None
        return before if most is None else max(before, most + 1)

    def populate(self, uids: DataFrame, order_by: list[str] | None = None,
                 check_unique: bool = True) -> int:
        """Load items in place of all that the table holds: each uid gets its
        running number (in ``order_by`` order) as component; ``uid`` must be
        unique and not null.  The round log starts a new epoch, so batches of
        earlier loads are not taken for replays."""
        _, width = self._checked(uids, check_unique)
        m = self._manifest()
        layer, written = self._layer(self._numbered(uids, order_by, 0))
        settings = (m["settings"] if m else self._settings())
        if not settings["width_given"]:
            settings = settings | {"uid_width": width}
        epoch = (m["epoch"] if m else 0) + 1
        return self._commit(self._new(m, "load", settings=settings, layers=[layer], history=None, streams={},
                                      round=0, batches={}, next=self._next(layer, 0), epoch=epoch), written)

    def add(self, uids: DataFrame, order_by: list[str] | None = None, existing: str = "keep",
            check_unique: bool = True) -> int:
        """Add items to the loaded table: a layer of their own, with numbers
        that go on after the greatest one.  A uid that is stored already keeps
        its row (``existing='keep'``), or takes a new number and leaves its
        component (``'replace'``).  No stored row is rewritten."""
        if existing not in ("keep", "replace"):
            raise ValueError("existing must be 'keep' or 'replace'")
        m = self._manifest()
        if m is None:
            return self.populate(uids, order_by, check_unique)
        n, width = self._checked(uids, check_unique)
        new = uids.withColumn("uid", F.col("uid").cast("string"))
        if existing == "keep":
            # The stored uids meet the new ones (an inner join, so few new
            # ones are broadcast and the table is streamed).
            new = materialize(new, "store-new")
            known = materialize(self.base().select("uid").join(new.select("uid"), "uid"), "store-known")
            new = new.join(known, "uid", "left_anti")
        layer, written = self._layer(self._numbered(new, order_by, m["next"]), replaces=existing == "replace")
        if existing == "keep":
            release(known)
        settings = m["settings"]
        if n and not settings["width_given"] and width != settings["uid_width"]:
            # The first items set the width; different ones have none in common.
            settings = settings | {"uid_width": None if m["layers"] else width}
        layers = m["layers"] + ([layer] if layer["shards"] else [])
        return self._commit(self._new(m, "add", settings=settings, layers=layers,
                                      next=self._next(layer, m["next"])), written)

    def drop(self, shard: int | None = None) -> None:
        """Drop the table (its own folders only), or, as a new version, one
        shard.  It is an error if there is nothing to drop."""
        m = self._manifest()
        if m is None:
            raise ValueError(f"no component table at {self.path}")
        if shard is None:
            for part in ("manifests", "data", "_quarantine"):
                delete_path(self.spark, f"{self.path}/{part}")
            return
        if not any(str(shard) in x["shards"] for x in m["layers"]):
            raise ValueError(f"{self.path} has no shard {shard}")
        layers = [x | {"shards": [s for s in x["shards"] if s != str(shard)]} for x in m["layers"]]
        self._commit(self._new(m, "drop", layers=[x for x in layers if x["shards"]]), [])

    def register(self, name: str = "components") -> str:
        """Expose the current table to ``spark.sql`` as a temporary view, so
        statements run against it with the optimizer's pruning and pushdown."""
        self.read().createOrReplaceTempView(name)
        return name

    # -- queries --------------------------------------------------------
    def lookup(self, uid: str) -> DataFrame:
        """Point lookup: the base row is found with partition pruning and a
        pushed filter, then only its own label is looked up in the history."""
        rows = lookup_uid(self.base(), uid, self.shard_fn)
        h = (self.history().join(rows.select(F.col("cmp").alias("old")), "old", "left_semi")
             .select(F.col("old").alias("id"), F.col("cur").alias("cmp")))
        return relabel(rows, h)

    def neighbors_of(self, uid: str, within_shard: bool = False) -> DataFrame:
        """Stored neighbours of one code, with their current labels.

        A code has at most L*(L-1) candidate neighbours (a fixed bound), so
        they are listed first and looked up in one scan that prunes to their
        shards and pushes ``uid IN (...)`` to Parquet, instead of a join with
        the whole table.
        """
        from ..operators.neighbors import neighbors

        one = self.spark.createDataFrame([(uid,)], "uid string")
        near = neighbors(one)
        if within_shard:
            near = near.join(one.select("uid", self.shard_fn(F.col("uid")).alias("own")), "uid")
            near = near.select(F.col("nbr").alias("uid"), "own").where(
                self.shard_fn(F.col("uid")).eqNullSafe(F.col("own"))).select(F.col("uid").alias("nbr"))
        cands = [r["nbr"] for r in near.select("nbr").collect()]
        if not cands:
            return self._resolve(self.base().where(F.lit(False)))
        shards = list({r[0] for r in self.spark.createDataFrame([(c,) for c in cands], "uid string")
                         .select(self.shard_fn(F.col("uid"))).collect()})
        in_shard = F.col("shard").isin([x for x in shards if x is not None])
        if None in shards:
            in_shard = in_shard | F.col("shard").isNull()
        rows = self.base().where(in_shard & F.col("uid").isin(cands))
        h = self.history().join(rows.select(F.col("cmp").alias("old")), "old", "left_semi")
        return resolve_labels(rows, h)

    def members(self, cmp: int) -> DataFrame:
        """The uids of component ``cmp``: rows whose label is ``cmp`` or one of
        the labels merged into it; none if ``cmp`` itself was merged into
        another.  Through the reverse index only the buckets of those labels
        are read."""
        m = self._need()
        h = self.history()
        if h.where(F.col("old") == cmp).limit(1).collect():
            return self.spark.createDataFrame([], "uid string")
        merged = h.where(F.col("cur") == cmp).select(F.col("old").alias("cmp"))
        few = [r["cmp"] for r in merged.limit(MAX_LITERALS + 1).collect()]
        indexed = all(x["index"] for x in m["layers"])
        rows = self._rows(m, "index" if indexed else "rows")
        if len(few) <= MAX_LITERALS:
            labels = [cmp, *few]
            rows = rows.where(F.col("cmp").isin(labels))
            if indexed:
                rows = rows.where(F.col("bucket").isin(sorted({x % m["settings"]["buckets"] for x in labels})))
            return rows.select("uid")
        olds = merged.unionByName(self.spark.range(1).select(F.lit(cmp).cast("bigint").alias("cmp")))
        if not indexed:
            return rows.join(olds, "cmp", "left_semi").select("uid")
        olds = olds.withColumn("bucket", F.pmod("cmp", F.lit(m["settings"]["buckets"])).cast("int"))
        return rows.join(olds, ["bucket", "cmp"], "left_semi").select("uid")

    # -- round log ------------------------------------------------------
    def _log(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], ROUND_LOG)
        entries = self.spark.read.schema(T.StructType([T.StructField("entry", ROUND_LOG)])).json(
            f"{self.path}/manifests")
        return entries.select("entry.*").where(F.col("version") <= self.current_version())

    def _epoch_log(self) -> DataFrame:
        m = self._manifest()
        return self._log().where(F.col("epoch") == (m["epoch"] if m else 0))

    def rounds(self) -> DataFrame:
        """The rounds since the items were last loaded, one ``c3`` each."""
        return self._epoch_log().where(F.col("message") == "c3")

    # -- rounds ---------------------------------------------------------
    def seen(self, source: str | None, batch_id: int | None) -> bool:
        """Whether this very batch was merged: every source counts its own."""
        if batch_id is None or source is None:
            return False
        m = self._manifest()
        last = m["batches"].get(source) if m else None
        if last is None or batch_id > last:
            return False  # a batch after all others: no need to read the log
        same = (F.col("batch_id") == batch_id) & (F.col("source") == source)
        return bool(self._epoch_log().where(same).limit(1).collect())

    def stream_state(self, source: str) -> dict[str, DataFrame]:
        """The written state of a stream, by name (empty before its first batch)."""
        names = self._need()["streams"].get(source, {})
        return {k: self.spark.read.parquet(self._data(n)) for k, n in names.items()}

    def merge_round(self, edges: DataFrame, on: str = "uid", src: str = "src", dst: str = "dst",
                    batch_id: int | None = None, source: str | None = None,
                    before_commit: Callable[[DataFrame], None] | None = None,
                    state: dict[str, DataFrame] | None = None, acknowledge: bool = True) -> RoundResult:
        """Merge one round of edges into the table.

        A batch is known by ``source`` and ``batch_id`` together and merged
        once; a batch id needs a source.  ``before_commit`` gets the edges
        with an unknown end before the round is written (a replay after a
        crash calls it again).  ``state`` is what the source has to remember
        (:meth:`stream_state`), committed with the round or not at all.  With
        ``acknowledge=False`` the batch is noted, but is not a round (``c3``).

        ``on='uid'``: edges name items; both ends are contracted to their
        current component (numbers are zero padded to the table's
        ``uid_width``, if it has one).  ``on='cmp'``: edges name component
        numbers, possibly ones merged away in earlier rounds; they are mapped
        through the label history first.  Then components are computed and
        every row of a merged component takes the least label, in one join.
        """
        if batch_id is not None and source is None:
            raise ValueError("a batch_id needs a source, or batches of two callers would be taken for one")
        if self.seen(source, batch_id):
            empty = self.spark.createDataFrame([], "id bigint, cmp bigint")
            return RoundResult(self.current_version(), empty,
                               self.spark.createDataFrame([], "src string, dst string"), skipped=True)
        m = self._need()
        scratch = []
        if on == "uid":
            e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
            if width := m["settings"]["uid_width"]:
                e = e.select(*(F.coalesce(code_of_number(c, width), F.col(c).cast("string")).alias(c)
                               for c in ("src", "dst")))
            # The round's edges are computed once (an edge rule may be a large
            # job) and read by both the contraction and the unknown-end report.
            e = materialize(e.select(F.col("src").cast("string"), F.col("dst").cast("string")),
                            "round-uid-edges")
            scratch.append(e)
            # Ends meet the base first; only their rows go through the history.
            con = contract_edges(e, self.base(), resolve=self._resolve)
            scratch.append(con.edges)
            cmp_edges, unknown = con.edges, con.unknown
        elif on == "cmp":
            h = self.history()
            e = edges.select(F.col(src).cast("bigint").alias("src"),
                             F.col(dst).cast("bigint").alias("dst"))
            for c in ("src", "dst"):
                hc = h.select(F.col("old").alias(c), F.col("cur").alias("_c"))
                e = e.join(hc, c, "left").select(
                    *(F.coalesce("_c", c).alias(c) if x == c else F.col(x) for x in ("src", "dst")))
            # Ends that name no current label are reported, not merged.  The
            # table meets only the round's distinct ends (inner join), once.
            e = materialize(e, "round-cmp-edges")
            scratch.append(e)
            ends = e.select(F.col("src").alias("_k")).unionByName(
                e.select(F.col("dst").alias("_k"))).distinct()
            # A current label is a base label that was never merged away.
            known = materialize(self.base().select(F.col("cmp").alias("_k")).join(ends, "_k").distinct()
                                .join(h.select(F.col("old").alias("_k")), "_k", "left_anti"), "round-known")
            scratch.append(known)
            ok = (e.join(known.withColumnRenamed("_k", "src"), "src", "left_semi")
                  .join(known.withColumnRenamed("_k", "dst"), "dst", "left_semi"))
            cmp_edges = ok.where(F.col("src") != F.col("dst"))
            unknown = (e.join(ok, ["src", "dst"], "left_anti")
                       .select(F.col("src").cast("string"), F.col("dst").cast("string")))
        else:
            raise ValueError("on must be 'uid' or 'cmp'")
        if before_commit:
            before_commit(unknown)
        return self._round(m, cmp_edges, unknown, batch_id, source, scratch, state, acknowledge)

    def _round(self, m: dict, cmp_edges: DataFrame, unknown: DataFrame, batch_id: int | None,
               source: str | None, scratch: list, state: dict[str, DataFrame] | None = None,
               acknowledge: bool = True) -> RoundResult:
        """Components of a round's edges on current labels, the new history
        and the round's entry, all in one commit."""
        stats: dict = {}
        small = connected_components(cmp_edges, stats=stats)
        counts = Observation()
        # Read several times below; counted on the way.
        labels = materialize(small.observe(counts, F.count(F.lit(1)).alias("n"),
                                           F.count_if(F.col("id") != F.col("cmp")).alias("merged")), "round-labels")
        release(small)
        n_vertices, n_merged = counts.get["n"], counts.get["merged"]
        history, written = m["history"], []
        if n_merged:
            history = self._write_history(advance_history(self.history(), labels))
            written.append(history)
        streams, batches = m["streams"], m["batches"]
        if state is not None:
            names = {k: self._write(df, f"state-{k}") for k, df in state.items()}
            written += names.values()
            streams = streams | {source: names}
        if batch_id is not None:
            batches = batches | {source: max(batch_id, batches.get(source, batch_id))}
        rnd = m["round"] + acknowledge
        entry = {"round": rnd, "batch_id": batch_id, "n_edges": stats["edges"], "n_unknown": unknown.count(),
                 "n_vertices": n_vertices, "n_merged": n_merged, "source": source}
        v = self._commit(self._new(m, "c3" if acknowledge else "batch", history=history, streams=streams,
                                   batches=batches, round=rnd, entry=entry), written)
        return RoundResult(v, labels, unknown, scratch=scratch + [labels])

    def map_round(self, edge_fn: Callable[[DataFrame], DataFrame] | None = None,
                  batch_id: int | None = None, source: str = "map") -> RoundResult:
        """One full round of the protocol: find edges between stored items
        with ``edge_fn(table) -> (src, dst)`` on uids (default: stored
        neighbour codes), then merge them."""
        source = source if batch_id is not None else None
        if edge_fn:
            return self.merge_round(edge_fn(self.read()), on="uid", batch_id=batch_id, source=source)
        if self.seen(source, batch_id):
            return self.merge_round(self.spark.createDataFrame([], "src string, dst string"),
                                    batch_id=batch_id, source=source)
        # Default rule: the neighbour graph comes from the base itself, as
        # stars of base labels around shared successors; both ends are moved
        # to current labels through the history.  No uid strings, no unknown
        # ends, no contraction joins.
        m = self._need()
        e = successor_edges(self.base())
        h = self.history()
        for c in ("src", "dst"):
            hc = h.select(F.col("old").alias(c), F.col("cur").alias("_c"))
            e = e.join(hc, c, "left").select(
                *(F.coalesce("_c", c).alias(c) if x == c else F.col(x) for x in ("src", "dst")))
        e = e.where(F.col("src") != F.col("dst"))
        none = self.spark.createDataFrame([], "src string, dst string")
        return self._round(m, e, none, batch_id, source, [])


def _bloom(col: str) -> dict[str, str]:
    """Parquet options: bloom filters of a fitting size for a column."""
    return {f"parquet.bloom.filter.enabled#{col}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _named(m: dict) -> set[str]:
    """The data that a manifest names."""
    out = {n for x in m["layers"] for n in (x["rows"], x["index"]) if n}
    out |= {n for names in m["streams"].values() for n in names.values()}
    return out | ({m["history"]} if m["history"] else set())
