"""New-entity share and month-over-month volume of providers or members.

Both compare a batch with a history table. For many runs at once, the spine has one
row per run: its keys, the lookup columns naming the history it reads (several runs
share one history), ``as_of`` and, if days are to be counted in the events' own offsets,
``as_of_day`` (their local date). History is rolled up to days before it meets the
runs. Day bounds make that exact: every window starts at midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimgauge.functions.expressions import days_before
from claimgauge.operators.joins import fits, linked
from claimgauge.operators.spine import Spine, over_runs
from claimgauge.session import require_utc


def _entity_rows(frame: DataFrame, entity: str, *columns: str) -> DataFrame:
    return frame.where(F.col(entity).isNotNull()).select(
        *columns, F.col(entity).alias("_entity")
    )


# ---- share of new entities -------------------------------------------------------

def new_entity_pct(batch: DataFrame, history: DataFrame | None, entity: str, as_of: Column,
                   item: str = "item_id", created: str = "created_at",
                   days: int = 90, items_fit: bool | None = None) -> DataFrame:
    """One run: distinct batch entities, how many history does not know, and the share.

    History counts from midnight ``days`` before the event, open-ended, without the
    rows whose item is in the batch. A missing history makes every entity new; an
    empty batch has share 0.
    """
    require_utc(batch.sparkSession)
    entities = _entity_rows(batch, entity).distinct()
    if history is None:
        return entities.agg(F.count(F.lit(1)).alias("total_entities")).select(
            "total_entities", F.col("total_entities").alias("new_entities"),
            F.lit(1.0).alias("new_pct"),
        )
    batch_items = batch.where(F.col(item).isNotNull()).select(item).distinct()
    recent = (history.where(F.col(created) >= days_before(as_of, days))
              .where(F.col(entity).isNotNull())
              .select(item, F.col(entity).alias("_entity")))
    small = fits(batch_items) if items_fit is None else items_fit
    others = linked(recent, batch_items, [item], small, "left_anti")
    known = (others.select("_entity").distinct().withColumn("_known", F.lit(True)))
    counts = entities.join(known, "_entity", "left").agg(
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if(F.col("_known").isNull()).alias("new_entities"),
    )
    return counts.select("total_entities", "new_entities", _new_pct())


def _beyond(columns: list[str], others: list[str]) -> list[str]:
    return [c for c in columns if c not in others]


def _new_pct() -> Column:
    share = F.try_divide(F.col("new_entities").cast("double"), F.col("total_entities"))
    return F.coalesce(share, F.lit(0.0)).alias("new_pct")


def _runs_since(spine: Spine, days: int, name: str) -> DataFrame:
    """The runs with their day bound, for joining to data."""
    columns = dict.fromkeys([*spine.keys, *spine.lookup])
    day = "as_of_day" if "as_of_day" in spine.runs.columns else "as_of"
    return spine.links.select(*columns, days_before(F.col(day), days).alias(name))


def _running(changes: DataFrame, asking: DataFrame, group: list[str],
             *values: str) -> DataFrame:
    """``asking`` (``group``, ``_at``) with the sums of ``values`` over the ``changes`` of its
    group at or before its ``_at``.

    Both lie in one ordered window: a row is read once, however many runs ask, and no
    row is copied per run.
    """
    rows = changes.select(*group, "_at", *values, F.lit(0).alias("_asks")).unionByName(
        asking.withColumn("_asks", F.lit(1)), allowMissingColumns=True)
    so_far = (Window.partitionBy(*group).orderBy("_at", "_asks")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumns({v: F.sum(v).over(so_far) for v in values}).where(
        F.col("_asks") == 1).drop("_asks")


def _days_back(day: Column) -> Column:
    """Days counted backwards, so that sums up to a day are sums from that day on."""
    return -F.unix_date(day)


def new_entity_pct_by_run(spine: Spine, batch: DataFrame, history: DataFrame, entity: str,
                          item: str = "item_id", created: str = "created_at",
                          days: int = 90, items_fit: bool | None = None) -> DataFrame:
    """:func:`new_entity_pct` for every run of the spine.

    An entity is known to a run when its history rows in the window outnumber those
    of them whose item is in the run's batch. The first count comes from a roll-up of
    history per entity and day, the second from the history of batch items per item,
    entity and day; both are running sums that the runs look up. ``items_fit`` says
    whether the batch items may be broadcast (see ``joins.fits``); it is measured if
    not given.
    """
    keys, history_keys = list(spine.keys), list(spine.lookup)
    links = _runs_since(spine, days, "_from").withColumn("_at", _days_back(F.col("_from")))

    entities = _entity_rows(batch, entity, *keys).distinct()
    items = batch.where(F.col(item).isNotNull()).select(*keys, item).distinct()
    recent = (
        history.where(F.col(created) >= days_before(spine.first, days + 1))
        .where(F.col(entity).isNotNull())
        .select(*history_keys, item, F.col(entity).alias("_entity"),
                _days_back(F.to_date(created)).alias("_at"))
    )

    seen = recent.groupBy(*history_keys, "_entity", "_at").agg(F.count(F.lit(1)).alias("_n"))
    in_window = _running(
        seen, entities.join(links, keys).select(*keys, *_beyond(history_keys, keys), "_entity", "_at"),
        [*history_keys, "_entity"], "_n").select(*keys, "_entity", "_n")

    batch_items = items.join(links, keys).select(*keys, *_beyond(history_keys, keys), item, "_at")
    wanted = batch_items.select(*history_keys, item).distinct()
    small = fits(wanted) if items_fit is None else items_fit
    per_day = [*history_keys, item, "_entity", "_at"]
    if small:
        own = linked(recent, wanted, [*history_keys, item], True, "left_semi")
        touched = own.groupBy(*per_day).agg(F.count(F.lit(1)).alias("_n"))
    else:
        # rolled up first, so an item of many rows is one row per entity and day when it is joined
        rolled = recent.where(F.col(item).isNotNull()).groupBy(*per_day).agg(
            F.count(F.lit(1)).alias("_n"))
        touched = rolled.join(wanted, [*history_keys, item], "left_semi")
    known_as = touched.select(*history_keys, item, "_entity").distinct()
    own_rows = _running(
        touched, batch_items.join(known_as, [*history_keys, item]).select(
            *keys, *_beyond(history_keys, keys), item, "_entity", "_at"),
        [*history_keys, item, "_entity"], "_n",
    ).groupBy(*keys, "_entity").agg((-F.sum("_n")).alias("_n"))
    balance = (
        in_window.withColumn("_in_batch", F.lit(1))
        .unionByName(own_rows, allowMissingColumns=True)
        .groupBy(*keys, "_entity")
        .agg(F.sum("_n").alias("_n"), F.max("_in_batch").alias("_in_batch"))
        .where(F.col("_in_batch").isNotNull())
    )
    counts = balance.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if(F.coalesce("_n", F.lit(0)) <= 0).alias("new_entities"),
    )
    return over_runs(spine.index, counts, keys).select(
        *keys,
        F.coalesce("total_entities", F.lit(0)).alias("total_entities"),
        F.coalesce("new_entities", F.lit(0)).alias("new_entities"),
        _new_pct(),
    )


# ---- volume ratio ----------------------------------------------------------------

def _volume(latest: str = "latest_count", previous: str = "previous_count") -> Column:
    share = F.try_divide(F.col(latest).cast("double"), F.col(previous))
    return F.coalesce(share, F.lit(1.0)).alias("ratio")


def volume_ratio(batch: DataFrame, history: DataFrame | None, entity: str, as_of: Column,
                 created: str = "created_at", days: int = 30) -> DataFrame:
    """One run: distinct entities of the last ``days`` (with the batch, open-ended)
    over those of the ``days`` before. 1.0 without previous entities or history."""
    if history is None:
        return batch.sparkSession.range(1).select(
            F.lit(None).cast("bigint").alias("latest_count"),
            F.lit(None).cast("bigint").alias("previous_count"),
            F.lit(1.0).alias("ratio"),
        )
    require_utc(batch.sparkSession)
    cut = days_before(as_of, days)
    recent = history.where(F.col(created) >= days_before(as_of, 2 * days))
    latest = F.col(created) >= cut
    rows = recent.select(F.col(entity).alias("_entity"), latest.alias("_latest"),
                         (~latest).alias("_previous")).unionByName(
        batch.select(F.col(entity).alias("_entity"), F.lit(True).alias("_latest"),
                     F.lit(False).alias("_previous"))
    )
    # one row per entity first: two distinct counts without expanding the rows
    per_entity = rows.where(F.col("_entity").isNotNull()).groupBy("_entity").agg(
        F.bool_or("_latest").alias("_latest"), F.bool_or("_previous").alias("_previous")
    )
    return per_entity.agg(
        F.count_if("_latest").alias("latest_count"),
        F.count_if("_previous").alias("previous_count"),
    ).select("latest_count", "previous_count", _volume())


def volume_ratio_by_run(spine: Spine, batch: DataFrame, history: DataFrame, entity: str,
                        created: str = "created_at", days: int = 30) -> DataFrame:
    """:func:`volume_ratio` for every run of the spine.

    History shrinks to one row per entity and active day. Such a row is the entity's
    latest day for exactly the cuts between it and the next active day, so summing
    +1 where that stretch begins and -1 where it ends gives, per history and day, the
    number of distinct entities in the window: running sums over the days of a history,
    which each run looks up at its own day. Besides that a run costs its batch.
    """
    keys, history_keys = list(spine.keys), list(spine.lookup)
    links = _runs_since(spine, days, "_cut")

    active = (
        history.where(F.col(created) >= days_before(spine.first, 2 * days + 1)).where(F.col(entity).isNotNull())
        .select(*history_keys, F.col(entity).alias("_entity"), F.to_date(created).alias("_day"))
        .distinct()
        .withColumn("_next", F.lead("_day").over(
            Window.partitionBy(*history_keys, "_entity").orderBy("_day")))
    )

    # cuts c with _day < c <= _next and c - days <= _day see this row
    ends = F.least(F.date_add("_day", days + 1), F.date_add("_next", 1))
    changes = active.select(
        *history_keys,
        F.inline(F.array(
            F.struct(F.date_add("_day", 1).alias("_at"), F.lit(1).alias("_previous"),
                     F.lit(0).alias("_latest")),
            F.struct(ends.alias("_at"), F.lit(-1).alias("_previous"), F.lit(0).alias("_latest")),
            # the last active day: counted as latest by every cut up to it
            F.struct(F.when(F.col("_next").isNull(), F.col("_day")).alias("_at"),
                     F.lit(0).alias("_previous"), F.lit(1).alias("_latest")),
        )),
    ).where(F.col("_at").isNotNull()).groupBy(*history_keys, "_at").agg(
        F.sum("_previous").alias("_previous"), F.sum("_latest").alias("_latest")
    )
    # latest rows count from their day on: they end to matter to cuts after it
    steps = changes.select(*history_keys, F.col("_at"), F.col("_previous"), F.lit(0).alias("_past")
                           ).unionByName(changes.select(
                               *history_keys, F.date_add("_at", 1).alias("_at"),
                               F.lit(0).alias("_previous"), F.col("_latest").alias("_past")))
    whole = changes.groupBy(*history_keys).agg(F.sum("_latest").alias("_all"))
    asking = links.select(*keys, *_beyond(history_keys, keys), F.col("_cut").alias("_at"))
    from_history = _running(steps, asking, history_keys, "_previous", "_past").join(
        whole, history_keys).select(
            *keys, "_previous", (F.col("_all") - F.coalesce("_past", F.lit(0))).alias("_latest"))

    # batch entities the latest part of history lacks
    last_day = active.where(F.col("_next").isNull()).select(
        *history_keys, "_entity", F.col("_day").alias("_last"))
    only_batch = (
        _entity_rows(batch, entity, *keys).distinct().join(links, keys)
        .join(last_day, [*history_keys, "_entity"], "left")
        .where(F.col("_last").isNull() | (F.col("_last") < F.col("_cut")))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("_latest"))
    )
    counts = (
        from_history.unionByName(only_batch, allowMissingColumns=True)
        .groupBy(*keys).agg(F.sum("_latest").alias("latest_count"),
                            F.sum("_previous").alias("previous_count"))
    )
    return over_runs(spine.index, counts, keys).select(
        *keys,
        F.coalesce("latest_count", F.lit(0)).alias("latest_count"),
        F.coalesce("previous_count", F.lit(0)).alias("previous_count"),
    ).select("*", _volume())
