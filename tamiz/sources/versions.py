"""A warehouse of versions: each load is there as a whole or not at all, and counts once.

    <path>/data/<table>/<load>-<attempt>/       Parquet files, written once and never changed
    <path>/versions/000000001.json              which folders make up which table, and the loads so far

A load writes and checks all its tables first. Then one small file is renamed into place: from that moment
readers see the new version of all tables, before it they see the old one of all. A load that breaks off
leaves folders that no version names (``drop_unused`` deletes them). A load whose id the version already
names does nothing, so a job that was started again counts once. Of two loads at the same time one renames
first; the other finds its number taken, fails, and can be started again.

The rename has to be atomic and to refuse an existing target, as it does on HDFS and on local disks.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators.quarantine import ALL_RULES, Quarantine, quarantine
from tamiz.schemas import WAREHOUSE, Table
from tamiz.session import COMPACT, build_together, shuffles_dropped

MODES = ("append", "replace")


class LoadConflict(RuntimeError):
    """Another load was committed in the meantime."""


@dataclass(frozen=True)
class Version:
    """``tables`` and ``rejects`` name the folders of each table, ``loads`` all load ids so far."""

    number: int
    loads: tuple[str, ...]
    tables: dict[str, tuple[str, ...]]
    rejects: dict[str, tuple[str, ...]]


class VersionedWarehouse:
    def __init__(self, spark: SparkSession, path: str, tables: Sequence[Table] = tuple(WAREHOUSE.values())):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas = {t.name: t for t in tables}

    # ---- files -------------------------------------------------------------

    def _hadoop(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        files, place = self._hadoop(path)
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def _commit(self, version: Version) -> None:
        """Write the file of a version aside and rename it; an error if the number is taken."""
        jvm = self.spark._jvm
        text = json.dumps({
            "loads": version.loads, "tables": version.tables, "rejects": version.rejects,
        }, indent=1, sort_keys=True)
        files, aside = self._hadoop(f"{self.path}/versions/_{uuid.uuid4().hex}")
        stream = files.create(aside, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        _, place = self._hadoop(f"{self.path}/versions/{version.number:09d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(place), options)
        except Exception as error:
            files.delete(aside, False)
            if files.exists(place):
                raise LoadConflict(f"version {version.number} is there already: start the load again") from error
            raise

    # ---- reading -----------------------------------------------------------

    def versions(self) -> list[int]:
        found = (re.fullmatch(r"(\d{9})\.json", n) for n in self._names(f"{self.path}/versions"))
        return sorted(int(m.group(1)) for m in found if m)

    def version(self, number: int | None = None) -> Version:
        """The version of that number, the latest without one; number 0 is the empty warehouse."""
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return Version(0, (), {}, {})
        files, place = self._hadoop(f"{self.path}/versions/{number:09d}.json")
        stream = files.open(place)
        try:
            held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        folders = {k: {n: tuple(f) for n, f in held[k].items()} for k in ("tables", "rejects")}
        return Version(number, tuple(held["loads"]), folders["tables"], folders["rejects"])

    def table(self, name: str, version: Version | int | None = None) -> DataFrame:
        """A table as of a version; a table that was never loaded is empty."""
        at = version if isinstance(version, Version) else self.version(version)
        folders = [f"{self.path}/data/{f}" for f in at.tables.get(name, ())]
        struct = self.schemas[name].struct
        if not folders:
            return self.spark.createDataFrame([], struct)
        return self.spark.read.schema(struct).parquet(*folders)

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables, all of the same version."""
        at = self.version(version)
        return {name: self.table(name, at) for name in self.schemas}

    def rejects(self, name: str, version: int | None = None) -> DataFrame | None:
        """What quarantine kept out of a table, null if nothing ever was."""
        folders = [f"{self.path}/data/{f}" for f in self.version(version).rejects.get(name, ())]
        return self.spark.read.option("mergeSchema", True).parquet(*folders) if folders else None

    def create_views(self, prefix: str = "", version: int | None = None) -> None:
        """Temporary views over all tables of one version, for SQL."""
        for name, df in self.tables(version).items():
            df.createOrReplaceTempView(f"{prefix}{name}")

    # ---- loading -----------------------------------------------------------

    def load(
        self,
        load_id: str,
        tables: Mapping[str, DataFrame],
        mode: str | Mapping[str, str] = "append",
        order: Sequence[str] | None = None,
        rules: Sequence[str] = ALL_RULES,
        on_violation: str = "refuse",
        order_by: Mapping[str, Sequence[str]] | None = None,
    ) -> Version:
        """Add a load: rows are appended to their tables, or replace them, by ``mode`` (one for all or by table).

        Rows that break one of ``rules`` let the whole load fail with ``on_violation="refuse"``; with
        ``"quarantine"`` they are kept apart with the version, and the others are loaded. Dimensions come
        before the facts that refer to them, so rows that refer to a rejected member are rejected too.
        Uniqueness holds over the rows loaded before. ``order`` names tables that have to be there.
        """
        if on_violation not in ("refuse", "quarantine"):
            raise ValueError(f"on_violation must be refuse or quarantine, not {on_violation!r}")
        modes = {n: mode if isinstance(mode, str) else mode.get(n, "append") for n in tables}
        if set(modes.values()) - set(MODES):
            raise ValueError(f"mode must be one of {MODES}")
        if not re.fullmatch(r"[\w.\-]+", load_id):
            raise ValueError("a load id is made of letters, digits, dots, dashes and underscores")
        missing = [n for n in order or () if n not in tables]
        if missing:
            raise ValueError(f"tables missing from the load: {', '.join(missing)}")
        unknown = [n for n in tables if n not in self.schemas]
        if unknown:
            raise ValueError(f"not tables of this warehouse: {', '.join(unknown)}")
        base = self.version()
        if load_id in base.loads:
            return base
        attempt = f"{load_id}-{uuid.uuid4().hex[:8]}"
        folders, rejects = dict(base.tables), dict(base.rejects)
        good: dict[str, DataFrame] = {}

        def settle(name: str) -> list[str]:
            """Judge and write one table; what breaks a rule, if that refuses the load."""
            split = self._judged(name, tables[name], base, modes, good, rules, (order_by or {}).get(name, ()))
            if on_violation == "refuse":
                report = split.report().collect()  # a row per column and rule at most
                if report:
                    return [f"{name}.{r['column']}: {r['rows']} rows break {r['rule']}" for r in report]
            elif not split.rejects.isEmpty():
                place = f"{name}/{attempt}-rejects"
                split.rejects.write.options(**COMPACT).parquet(f"{self.path}/data/{place}")
                rejects[name] = (*rejects.get(name, ()), place)
            place = f"{name}/{attempt}"
            self._write(split.good, f"{self.path}/data/{place}")
            split.drop()
            earlier = folders.get(name, ()) if modes[name] == "append" else ()
            folders[name] = (*earlier, place)
            good[name] = self.spark.read.schema(self.schemas[name].struct).parquet(f"{self.path}/data/{place}")
            return []

        # Tables that refer to others come after all of these; those of a group go side by side.
        groups = ([n for n in tables if not self.schemas[n].references], [n for n in tables if self.schemas[n].references])
        for group in filter(None, groups):
            found = build_together(self.spark, {n: lambda n=n: settle(n) for n in group})
            problems = sorted(p for lines in found.values() for p in lines)
            if problems:
                raise ValueError("nothing was loaded; " + "; ".join(problems))
        version = Version(base.number + 1, (*base.loads, load_id), folders, rejects)
        self._commit(version)
        return version

    @staticmethod
    def _write(df: DataFrame, path: str) -> None:
        with shuffles_dropped(df.sparkSession):
            df.write.options(**COMPACT).parquet(path)

    def _judged(self, name, df, base, modes, good, rules, order_by) -> Quarantine:
        table = self.schemas[name]

        def whole(other: str) -> DataFrame:
            """A dimension as it will be: this load's rows, with the earlier ones unless they are replaced."""
            if other not in good:
                return self.table(other, base)
            return good[other] if modes[other] == "replace" else self.table(other, base).unionByName(good[other])

        parents = {parent: whole(parent) for parent, _ in table.references.values() if parent in self.schemas}
        known = self.table(name, base) if modes[name] == "append" and base.tables.get(name) else None
        return quarantine(df, table, rules, order_by, known, parents)

    def compact(self, load_id: str, names: Sequence[str] | None = None) -> Version:
        """Rewrite tables that many loads have added to as one folder each, as a version of its own."""
        base = self.version()
        chosen = [n for n in (names or base.tables) if len(base.tables.get(n, ())) > 1]
        if load_id in base.loads or not chosen:
            return base
        folders = dict(base.tables)
        for name in chosen:
            place = f"{name}/{load_id}-{uuid.uuid4().hex[:8]}"
            self._write(self.table(name, base), f"{self.path}/data/{place}")
            folders[name] = (place,)
        version = Version(base.number + 1, (*base.loads, load_id), folders, base.rejects)
        self._commit(version)
        return version

    def drop_unused(self, keep: int = 1) -> list[str]:
        """Delete the folders that none of the last ``keep`` versions names, and the files of older versions.

        Not while a load is under way: its folders are not named yet.
        """
        numbers = self.versions()
        kept = [self.version(n) for n in numbers[-keep:]] if keep else []
        used = {f for v in kept for held in (v.tables, v.rejects) for fs in held.values() for f in fs}
        dropped = []
        for name in self._names(f"{self.path}/data"):
            for folder in self._names(f"{self.path}/data/{name}"):
                if f"{name}/{folder}" not in used:
                    files, place = self._hadoop(f"{self.path}/data/{name}/{folder}")
                    files.delete(place, True)
                    dropped.append(f"{name}/{folder}")
        for number in numbers[:-keep] if keep else numbers:
            files, place = self._hadoop(f"{self.path}/versions/{number:09d}.json")
            files.delete(place, False)
        return sorted(dropped)

    def history(self) -> DataFrame:
        """version, load_id, table, folders: what each kept version added, in order."""
        rows, before = [], Version(0, (), {}, {})
        for number in self.versions():
            at = self.version(number)
            new = [x for x in at.loads if x not in before.loads]
            for name, folders in at.tables.items():
                added = [f for f in folders if f not in before.tables.get(name, ())]
                rows += [(number, x, name, len(added)) for x in new if added]
            before = at
        return self.spark.createDataFrame(rows, "version long, load_id string, table string, folders long")


def each_owner_once(known: DataFrame, incoming: DataFrame, owner: str) -> DataFrame:
    """Rows of a fact after a later load: an owner's known rows give way to its incoming ones."""
    owners = incoming.select(F.col(owner)).distinct()
    return known.join(owners, owner, "left_anti").select(*known.columns).unionByName(incoming.select(*known.columns))
