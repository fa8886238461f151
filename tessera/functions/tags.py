"""Run-tag (``map<string,string>``) expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import (LABEL_DEFAULT, TAG_AUTO_MATERIALIZE, TAG_BACKFILL,
                             TAG_SCHEDULE)


def tag(tags: Column | str, name: str) -> Column:
    """Null-safe lookup: a missing key gives null (``try_element_at``)."""
    m = F.col(tags) if isinstance(tags, str) else tags
    return F.try_element_at(m, F.lit(name))


def tag_or(tags, name: str, default: str) -> Column:
    return F.coalesce(tag(tags, name), F.lit(default))


def sparse_map(*pairs: tuple[str, Column]) -> Column:
    """``map`` from (key, value) pairs, dropping entries whose value is null."""
    flat: list[Column] = []
    for k, v in pairs:
        flat += [F.lit(k), v]
    return F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull())


def trigger_type(tags) -> Column:
    """backfill > schedule > auto_materialize (non-empty value) > manual.

    Backfill and schedule test for presence; auto-materialize for a truthy,
    i.e. non-empty, value.
    """
    bf, sch, auto = tag(tags, TAG_BACKFILL), tag(tags, TAG_SCHEDULE), tag(tags, TAG_AUTO_MATERIALIZE)
    return (F.when(bf.isNotNull(), F.lit("backfill"))
            .when(sch.isNotNull(), F.lit("schedule"))
            .when(auto.isNotNull() & (auto != F.lit("")), F.lit("auto_materialize"))
            .otherwise(F.lit("manual")))


def trigger_name(tags) -> Column:
    bf, sch = tag(tags, TAG_BACKFILL), tag(tags, TAG_SCHEDULE)
    return F.coalesce(bf, sch, F.lit(LABEL_DEFAULT))
