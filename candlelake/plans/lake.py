"""The stored tables and the load that keeps them current.

Silver and facts are partitioned by month. A load reads and rewrites only the months its
rows fall in; the business keys contain the date, so a month is closed under its keys and
merging it alone gives the same result as merging the whole table.

A delivery is noted in a journal before anything else happens to it. A load that stopped is picked up by
the next one, delivery after delivery; one that is older than what silver holds is spliced into the
versions, from the rows of the deliveries since.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake import schemas
from candlelake.context import DIM_SYMBOL_SPEC, FACT_DAILY_SPEC, SILVER_SPEC, BatchContext
from candlelake.operators import dims, facts, sinks, states, upkeep
from candlelake.operators.history import splice_merge
from candlelake.operators.merge import changed_rows, differing, fact_sync, scd_merge
from candlelake.plans.silver import flat_bronze, rejected_bars, silver_source
from candlelake.sources import responses

MONTH = "Month"
SORT = {"silver": ("Symbol", "Date"), "fact_daily": ("SymbolSID", "DateID")}
LANDED, SILVER, GOLD, RETIRED = "landed", "silver", "gold", "retired"
# Table properties: the highest fact id reserved, the last load whose gold steps all finished, the last lookup,
# months whose states are older than their facts.
TOP_ID, GOLD_MARK, LOOKUP_MARK = "candlelake.top_id", "candlelake.gold_mark", "candlelake.lookup_mark"
STALE_MONTHS = "candlelake.stale_months"
STAGED = ("landed", "flat", "facts", "members")


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


@dataclass(frozen=True)
class Delivery:
    """One delivery as the journal knows it: the folder every finished step left."""

    number: int
    batch: BatchContext
    paths: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Lake:
    """Table names and folders of one lake; ``root`` is a folder all executors can reach.

    ``groupings`` names the groups, by columns of the star, whose month states are kept with the facts.
    """

    spark: SparkSession
    root: str
    prefix: str = "lake"
    groupings: tuple[tuple[str, ...], ...] = ()

    def name(self, kind: str) -> str:
        return f"{self.prefix}_{kind}"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def table(self, kind: str) -> DataFrame:
        return self.spark.table(self.name(kind))

    # -- creation ---------------------------------------------------------------------------

    def create(self, replace: bool = False) -> None:
        for kind in ("silver", "fact_daily"):
            ddl = f"{schemas.TABLES[kind]}, {MONTH} INT"
            sinks.create_table(self.spark, self.name(kind), ddl, self.path(kind), replace, partition_by=MONTH)
        for by in self.groupings:
            kind = self.states_kind(by)
            sinks.create_table(self.spark, self.name(kind), states.state_ddl(by), self.path(kind), replace, MONTH)
        self.spark.createDataFrame([], schemas.JOURNAL).write.mode("overwrite" if replace else "append") \
            .parquet(self.path("journal"))
        for kind in ("dim_symbol", "dim_date", "symbol_lookup"):
            sinks.create_known_table(self.spark, self.name(kind), self.path(kind, "empty"), kind, replace)

    def seed_lookup(self, lookup: DataFrame, batch: BatchContext) -> None:
        self._switch("symbol_lookup", lookup, batch)
        self._set_property("symbol_lookup", LOOKUP_MARK, batch.start)

    # -- one load ---------------------------------------------------------------------------

    def land(self, landed: DataFrame, batch: BatchContext) -> None:
        """Keep the good responses for the load and the others for inspection, then note the delivery."""
        path = self._fresh("deliveries", batch)
        responses.accept(landed).write.parquet(path)
        responses.reject(landed).write.mode("overwrite").json(self.path("rejected", batch.batch_id))
        number = max((delivery.number for delivery in self._journal()), default=0) + 1
        self._note(Delivery(number, batch), LANDED, path)

    def replay(self) -> None:
        """Bring every landed delivery that has not reached silver there, in the order they came."""
        for delivery in self.deliveries():
            if SILVER not in delivery.paths:
                landed = self.spark.read.schema(schemas.BRONZE).parquet(delivery.paths[LANDED])
                sinks.overwrite_partitions(landed, self.path("bronze"))
                rows = self.load_silver(landed.select("symbol").distinct(), delivery.batch)
                self._note(delivery, SILVER, rows)

    def load_silver(self, symbols: DataFrame, batch: BatchContext) -> str | None:
        """Merge the stored bronze of the delivered symbols; months without any change are not rewritten.

        Returns the folder with the delivered rows.
        """
        if symbols.isEmpty():
            return None
        bronze = responses.read_bronze(self.spark, self.path("bronze"), symbols)
        flat = self._staged(flat_bronze(bronze), "flat", batch)
        rejected_bars(flat).write.mode("overwrite").json(self.path("rejected_bars", batch.batch_id))
        path = self._fresh("observed", batch)
        silver_source(flat, batch).withColumn(MONTH, month_of(F.col("Date"))).write.parquet(path)
        source = self._observed([path])
        months = self._months(source.select(MONTH))
        since = [delivery.paths[SILVER] for delivery in self.deliveries() if delivery.paths.get(SILVER)]
        if any(delivery.batch.start > batch.start for delivery in self._journal() if SILVER in delivery.paths):
            inside = F.col(MONTH).isin(months)
            merged = splice_merge(self._months_of("silver", months), source.drop(MONTH), SILVER_SPEC,
                                  self._observed(since).filter(inside).drop(MONTH) if since else None)
        else:
            delivered = self._months_of("silver", months)
            months = self._months(changed_rows(delivered, source, SILVER_SPEC).select(MONTH))
            merged = scd_merge(self._months_of("silver", months),
                               source.filter(F.col(MONTH).isin(months)).drop(MONTH), SILVER_SPEC, batch)
        self._replace("silver", merged, month_of(F.col("Date")), months, batch)
        return path

    def load_dim_symbol(self, batch: BatchContext) -> None:
        """Versions from the rows changed since the last load; from all rows if the lookup is newer than that."""
        mark, lookup = self._property("fact_daily", GOLD_MARK), self._property("symbol_lookup", LOOKUP_MARK)
        renewed = mark and lookup and lookup >= mark
        rows = self.table("silver").filter("__CurrentFlag") if renewed else self._changed()
        if rows.isEmpty():
            return
        before = dims.member_dim(self.table("dim_symbol")) if self.groupings else None
        if before is not None:
            before = self._staged(before, "members", batch)
        built = dims.build_dim_symbol(self.table("dim_symbol"), rows, self.table("symbol_lookup"), batch)
        self._switch("dim_symbol", built, batch)
        if before is not None:
            self._note_renamed(before)

    def load_facts(self, batch: BatchContext) -> None:
        """Sync every month with a changed silver row, or with rows of a symbol that only now has an id.

        A month is synced against all of its silver rows. Facts are daily: responses with several
        values per symbol and day are refused here.
        """
        months = sorted({*self._months(self._changed().select(MONTH)), *self._months_of_new_symbols()})
        if not months:
            return
        silver = self._months_of("silver", months)
        source = self._staged(facts.fact_source(silver, self.table("dim_symbol"), batch), "facts", batch)
        month = F.floor(F.col("DateID") / 100).cast("int")
        months = self._months(differing(self._months_of("fact_daily", months), source, FACT_DAILY_SPEC, month))
        if not months:
            return
        synced = fact_sync(
            self._months_of("fact_daily", months), source.filter(month.isin(months)), FACT_DAILY_SPEC,
            id_column="TransactionSID", above=F.lit(self._top_id()))

        def before_switch(written: DataFrame) -> None:
            self._reserve_ids(written)
            self._note_stale(months)

        self._replace("fact_daily", synced, month, months, batch, before_switch)

    def load_dim_date(self, batch: BatchContext) -> None:
        changed = self._changed().select("Date")
        if not changed.isEmpty():
            self._switch("dim_date", dims.extend_calendar(self.table("dim_date"), changed), batch)

    def refresh_states(self, batch: BatchContext) -> None:
        """Make the states of the months whose facts changed anew, also those an earlier load did not get to."""
        months = self._stale()
        if not self.groupings or not months:
            return
        star = facts.star(self.table("fact_daily").filter(F.col(MONTH).isin(months)), self.table("dim_date"),
                          dims.member_dim(self.table("dim_symbol")), MONTH)
        for by in self.groupings:
            kind, made = self.states_kind(by), states.month_states(star, by)
            sinks.replace_partitions(self.spark, self.name(kind), made, MONTH, months, self._fresh(kind, batch), by)
        self._set_property("fact_daily", STALE_MONTHS, "")

    def load(self, landed: DataFrame, batch: BatchContext) -> None:
        """One delivery, after those that earlier loads left behind.

        Gold steps cover every delivery that has not been through them, and are dated no earlier than the last
        of them: a late delivery changes silver's past, while gold changes now.
        """
        landed = self._staged(landed, "landed", batch)  # documents are parsed once
        self.land(landed, batch)
        self.replay()
        mark = self._property("fact_daily", GOLD_MARK) or ""
        now = batch if batch.start >= mark else BatchContext(batch.batch_id, datetime.fromisoformat(mark))
        self.load_dim_symbol(now)
        self.load_facts(now)
        self.load_dim_date(now)
        self.refresh_states(now)
        self._set_property("fact_daily", GOLD_MARK, now.start)
        for delivery in self.deliveries():
            if GOLD not in delivery.paths:
                self._note(delivery, GOLD)

    # -- journal ----------------------------------------------------------------------------

    def deliveries(self) -> list[Delivery]:
        """The deliveries whose rows are kept, in the order they came."""
        return [delivery for delivery in self._journal() if RETIRED not in delivery.paths]

    def _journal(self) -> list[Delivery]:
        """All deliveries there have been; a few lines each."""
        found: dict[int, Delivery] = {}
        for row in self.spark.read.schema(schemas.JOURNAL).parquet(self.path("journal")).collect():
            batch = BatchContext(row["BatchId"], row["Start"])
            found.setdefault(row["Delivery"], Delivery(row["Delivery"], batch)).paths[row["Step"]] = row["Path"]
        return [found[number] for number in sorted(found)]

    def _note(self, delivery: Delivery, step: str, path: str | None = None) -> None:
        line = (delivery.number, delivery.batch.batch_id, delivery.batch.effective_ts, step, path)
        self.spark.createDataFrame([line], schemas.JOURNAL).coalesce(1).write.mode("append").parquet(self.path("journal"))

    def _observed(self, paths: Iterable[str]) -> DataFrame:
        """Audited rows as deliveries brought them."""
        return self.spark.read.schema(f"{schemas.SILVER}, {MONTH} INT").parquet(*paths)

    # -- upkeep -----------------------------------------------------------------------------

    def compact(self, batch: BatchContext, target_bytes: int = upkeep.TARGET_BYTES) -> dict[str, list[int]]:
        """Pack months that loads have left in too many files; returns the months by table."""
        return {kind: upkeep.compact(self.spark, self.name(kind), MONTH, self._fresh(kind, batch), target_bytes, SORT[kind])
                for kind in SORT}

    def sweep(self, before: datetime) -> list[str]:
        """Delete replaced folders last written before a time, and the rows of deliveries that went through before.

        A delivery that arrives after that and is older than the retired ones still finds its place between the
        versions, but cannot tell any more what they only confirmed.
        """
        kinds = [*SORT, "dim_symbol", "dim_date", "symbol_lookup", *(self.states_kind(by) for by in self.groupings)]
        inputs = [self.path(kind) for kind in ("deliveries", "observed")]
        old = {name.rsplit("/", 1)[1] for folder in inputs for name in upkeep.older_folders(self.spark, folder, before)}
        kept: list[str] = []
        for delivery in self.deliveries():
            paths = [path for path in delivery.paths.values() if path]
            if GOLD in delivery.paths and all(path.rsplit("/", 1)[1] in old for path in paths):
                self._note(delivery, RETIRED)
            else:
                kept += paths
        kept += upkeep.live_locations(self.spark, map(self.name, kinds))
        folders = [*map(self.path, kinds), *inputs, *(self.path("stage", label) for label in STAGED)]
        return upkeep.sweep(self.spark, folders, kept, before)

    # -- reading ----------------------------------------------------------------------------

    def star(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Facts under the attributes their symbols have now and the calendar, for the measures.

        Only months from the day ``first`` to the day ``last`` are read; a condition on the calendar prunes
        months as well, while the query runs.
        """
        rows = self.table("fact_daily")
        for day, inside in ((first, F.col(MONTH).__ge__), (last, F.col(MONTH).__le__)):
            if day:
                rows = rows.filter(inside(day.year * 100 + day.month))
        star = facts.star(rows, self.table("dim_date"), dims.member_dim(self.table("dim_symbol")), MONTH)
        bounds = [F.col("Date") >= F.lit(first)] * bool(first) + [F.col("Date") <= F.lit(last)] * bool(last)
        for bound in bounds:
            star = star.filter(bound)
        return star

    def states(self, by: tuple[str, ...] = ()) -> DataFrame:
        """Month states of one of the groupings, for :mod:`candlelake.operators.states`."""
        return self.table(self.states_kind(by))

    def states_kind(self, by: tuple[str, ...]) -> str:
        return "_".join(["states", *(name.lower() for name in by)])

    # -- helpers ----------------------------------------------------------------------------

    def _staged(self, df: DataFrame, label: str, batch: BatchContext) -> DataFrame:
        """Rows written once and read by several steps; survives the loss of any executor."""
        path = self.path("stage", label, batch.batch_id)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _changed(self) -> DataFrame:
        """Current silver rows of every delivery that has not been through gold."""
        waiting = [delivery.batch.start for delivery in self.deliveries() if GOLD not in delivery.paths]
        rows = self.table("silver").filter("__CurrentFlag")
        return rows.filter(F.col("__lastmodified") >= min(waiting)) if waiting else rows.limit(0)

    def _months_of_new_symbols(self) -> list[int]:
        """Months with rows of symbols whose first version came after the last finished load."""
        mark = self._property("fact_daily", GOLD_MARK)
        if not mark:
            return []
        versions = self.table("dim_symbol").groupBy(*DIM_SYMBOL_SPEC.business_columns) \
            .agg(F.min("__CreateDateTime").alias("since")).filter(F.col("since") > mark).drop("since")
        if versions.isEmpty():
            return []
        rows = self.table("silver").filter("__CurrentFlag").join(versions, list(DIM_SYMBOL_SPEC.business_columns))
        return self._months(rows.select(MONTH))

    def _months(self, months: DataFrame) -> list[int]:
        """Distinct months of a load; at most the calendar's length."""
        return [row[0] for row in months.distinct().collect() if row[0] is not None]

    def _months_of(self, kind: str, months: list[int]) -> DataFrame:
        return self.table(kind).filter(F.col(MONTH).isin(months)).drop(MONTH)

    def _replace(self, kind: str, df: DataFrame, month: Column, months: list[int], batch: BatchContext,
                 before_switch: Callable[[DataFrame], None] | None = None) -> None:
        sinks.replace_partitions(self.spark, self.name(kind), df.withColumn(MONTH, month), MONTH, months,
                                 self._fresh(kind, batch), SORT[kind], before_switch)

    def _switch(self, kind: str, df: DataFrame, batch: BatchContext) -> None:
        sinks.switch_location(self.spark, self.name(kind), df, self._fresh(kind, batch))

    def _fresh(self, kind: str, batch: BatchContext) -> str:
        """A folder no earlier attempt of the same batch has used."""
        return self.path(kind, f"{batch.batch_id}-{uuid.uuid4().hex[:8]}")

    def _top_id(self) -> int:
        """Highest fact id ever reserved, kept with the table so that no load scans for it."""
        return int(self._property("fact_daily", TOP_ID) or 0)

    def _reserve_ids(self, written: DataFrame) -> None:
        """Note the ids of written facts before any reader can see them: no later load hands them out again."""
        newest = written.agg(F.max("TransactionSID")).head()[0] or 0
        self._set_property("fact_daily", TOP_ID, str(max(self._top_id(), newest)))

    def _stale(self) -> list[int]:
        return [int(month) for month in (self._property("fact_daily", STALE_MONTHS) or "").split(",") if month]

    def _note_stale(self, months: Iterable[int]) -> None:
        """Remember months for the states before their facts change; at most the calendar's length."""
        if self.groupings:
            known = ",".join(map(str, sorted({*self._stale(), *months})))
            self._set_property("fact_daily", STALE_MONTHS, known)

    def _note_renamed(self, before: DataFrame) -> None:
        """Months with facts of symbols whose attributes are not what they were: their states change groups."""
        now = dims.member_dim(self.table("dim_symbol"))
        same = [F.col(f"b.{name}").eqNullSafe(F.col(f"n.{name}")) for name in now.columns]
        changed = now.alias("n").join(before.alias("b"), F.col("b.SymbolSID") == F.col("n.SymbolSID")) \
            .filter(~reduce(and_, same)).select("n.SymbolSID")
        if not changed.isEmpty():
            self._note_stale(self._months(self.table("fact_daily").join(changed, "SymbolSID").select(MONTH)))

    def _property(self, kind: str, key: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(kind)}").filter(F.col("key") == key).collect()
        return rows[0]["value"] if rows else None

    def _set_property(self, kind: str, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(kind)} SET TBLPROPERTIES ('{key}' = '{value}')")
