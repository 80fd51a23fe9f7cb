"""Hospital stays: date repair, merging of line items, readmission gaps.

A person may own any share of the rows, so line items are first counted per
(person, admission, discharge). What is left per person is bounded by the pairs
of calendar days, and only that goes through per-person windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from carespan.functions.values import DATE_FORMAT, days_between, parse_date
from carespan.operators.care import INPATIENT, care_type
from carespan.plans.numbering import PIECE, running_total, stage_pieces
from carespan.plans.skew import ROWS, attach, attach_measured, hot_limit, row_count
from carespan.sources.staging import stage, stage_and_measure


BLOCK = 1_000_000  # stay numbers in one window


def _date(df: DataFrame, name: str, fmt: str) -> Column:
    if isinstance(df.schema[name].dataType, (DateType, TimestampType)):
        return F.col(name).cast("date")
    return parse_date(name, fmt)


def repair_dates(
    df: DataFrame,
    *,
    start: str = "DT_INTERNACAO",
    end: str = "DT_ALTA",
    event: str = "DT_OCORR_EVENTO",
    out_start: str = "DT_INTERNACAO_CORRIGIDA",
    out_end: str = "DT_ALTA_CORRIGIDA",
    fmt: str = DATE_FORMAT,
    mode: str = "observed",
) -> DataFrame:
    """Fill a missing date from the event, then from the other date; parse; order.

    ``observed`` fills only the token ``'.'`` (text columns); ``intended`` fills
    whatever is no date.
    """
    if mode == "observed":
        missing = F.lit(".")

        def filled(name: str) -> Column:
            return F.when(F.col(name) == missing, F.col(event)).otherwise(F.col(name))

        s, e = filled(start), filled(end)
        s2 = F.when((s == missing) & (e != missing), e).otherwise(s)
        e2 = F.when((e == missing) & (s2 != missing), s2).otherwise(e)
        s, e = parse_date(s2, fmt), parse_date(e2, fmt)
    else:
        at = _date(df, event, fmt)
        s = F.coalesce(_date(df, start, fmt), at)
        e = F.coalesce(_date(df, end, fmt), at)
        s, e = F.coalesce(s, e), F.coalesce(e, s)
    return df.withColumns(
        {
            out_start: s,
            out_end: F.when(s > e, s).otherwise(e),
            event: _date(df, event, fmt),
        }
    )


def fill_stay_dates(
    df: DataFrame,
    *,
    start: str = "DT_INTERNACAO",
    end: str = "DT_ALTA",
    event: str = "DT_OCORR_EVENTO",
) -> DataFrame:
    """The short repair: ``'.'`` becomes the event date, nothing else."""
    return df.withColumns(
        {c: F.when(F.col(c) == ".", F.col(event)).otherwise(F.col(c)) for c in (start, end)}
    )


def _links(person: str, start: str, end: str, link: str):
    """(links to the row before, copies link to each other, order) in one person."""
    if link == "previous":
        s, e = F.col(start), F.col(end)
        order = [s.asc_nulls_first(), e.desc_nulls_last()]
        w = Window.partitionBy(person).orderBy(*order)
        seen = F.max(e).over(w.rowsBetween(Window.unboundedPreceding, 0))

        def near(day: Column) -> Column:
            return (F.date_sub(s, 1) <= day) & (F.date_add(seen, 1) >= day)

        linked = near(F.lag(start).over(w)) | near(F.lag(end).over(w))
        again = near(s) | near(e)
    elif link == "running_max":
        s, e = F.coalesce(start, end), F.coalesce(end, start)
        # the given dates part rows that are equal once filled
        order = [
            s.asc_nulls_first(),
            e.desc_nulls_last(),
            F.col(start).asc_nulls_first(),
            F.col(end).desc_nulls_last(),
        ]
        w = Window.partitionBy(person).orderBy(*order)
        seen = F.max(e).over(w.rowsBetween(Window.unboundedPreceding, -1))
        linked = s <= F.date_add(seen, 1)
        again = s.isNotNull()
    else:
        raise ValueError(f"link must be 'previous', 'running_max' or 'session', not {link!r}")
    known = F.col(person).isNotNull()
    return (
        F.coalesce(known & linked, F.lit(False)),
        F.coalesce(known & again, F.lit(False)),
        w,
        order,
    )


def _stay_groups(
    df: DataFrame, person: str, start: str, end: str, link: str
) -> tuple[DataFrame, dict]:
    """Per (person, start, end): the stay of its copies, with the stay's dates.

    Copies of a row without a person or a date cannot link to each other, so each
    is a stay of its own. Such a group has ``_spread`` true and two rows: the stay
    of its first copy and that of its last; copies between them stand alone.
    """
    linked, again, w, order = _links(person, start, end, link)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    groups = df.groupBy(person, start, end).agg(row_count())
    more = F.when(F.col("_again"), 0).otherwise(F.col(ROWS) - 1)
    ranged = (
        groups.repartitionByRange(F.col(person).asc_nulls_first())
        .withColumns({"_linked": linked, "_again": again})
        .withColumn("_weight", F.when(F.col("_linked"), 0).otherwise(1) + more)
        .withColumn("_last", F.sum("_weight").over(upto))
        .withColumn("_first", F.col("_last") - more)
        .withColumn("_spread", F.col("_first") < F.col("_last"))
        .withColumn("_edge", F.explode(F.array_distinct(F.array("_first", "_last"))))
    )
    one_stay = Window.partitionBy(person, "_edge")
    ranged = ranged.select(
        person,
        start,
        end,
        ROWS,
        "_spread",
        "_edge",
        "_first",
        # local total up to this row, and the part of it this row adds
        F.when(F.col("_edge") == F.col("_last"), F.col("_last"))
        .otherwise(F.col("_last") - F.col("_weight"))
        .alias("_local"),
        F.when(F.col("_edge") == F.col("_last"), F.col("_weight"))
        .otherwise(0)
        .alias("_adds"),
        F.min(start).over(one_stay).alias("_stay_start"),
        F.max(end).over(one_stay).alias("_stay_end"),
    )
    # the dates of the last copy's stay go along with the first's
    copies = Window.partitionBy(person, start, end)
    ranged = ranged.withColumns(
        {
            "_last_start": F.max_by("_stay_start", "_edge").over(copies),
            "_last_end": F.max_by("_stay_end", "_edge").over(copies),
        }
    )
    pieces, seen = stage_pieces(
        ranged,
        "stays",
        top=F.max(ROWS),
        spread=F.bool_or("_spread"),
    )
    order = [F.col(person).asc_nulls_first(), *order, F.col("_edge")]
    numbered = (
        running_total(pieces, order, "_adds", "_run")
        .withColumn("_id", F.col("_run") - F.col("_local") + F.col("_edge"))
        .withColumn("_at_first", F.col("_edge") == F.col("_first"))
        .drop("_run", "_local", "_adds", "_edge", "_first")
    )
    return numbered, seen


def _session_groups(
    df: DataFrame, person: str, start: str, end: str
) -> tuple[DataFrame, dict]:
    """As ``_stay_groups`` with the link ``running_max``, from session windows.

    A day of admission reaches to its latest discharge, and a window to the day after
    that, since windows that touch are merged. Only the days of a person go through the
    windows, not the lines. Rows without a person or a date are no part of a session.
    """
    s, e = F.coalesce(start, end), F.coalesce(end, start)
    dated = F.col(person).isNotNull() & s.isNotNull()
    groups = stage(
        df.groupBy(person, start, end)
        .agg(row_count())
        .withColumns({"_day": F.when(dated, s), "_until": F.greatest(s, e)}),
        "spans",
    )
    days = groups.filter(F.col("_day").isNotNull()).groupBy(person, "_day")
    days = days.agg(
        F.max("_until").alias("_until"),
        F.min(start).alias("_stay_start"),  # the given dates, as a stay has them
        F.max(end).alias("_stay_end"),
    )
    length = F.concat(F.date_diff("_until", "_day") + 1, F.lit(" days"))
    sessions = days.groupBy(
        person, F.session_window(F.col("_day").cast("timestamp"), length).alias("_window")
    ).agg(
        F.min("_day").alias("_first_day"),
        F.collect_list("_day").alias("_days"),
        F.min("_stay_start").alias("_stay_start"),
        F.max("_stay_end").alias("_stay_end"),
    )
    alone = groups.filter(F.col("_day").isNull()).select(
        person,
        s.alias("_first_day"),
        e.alias("_last_day"),
        F.col(start).alias("_stay_start"),
        F.col(end).alias("_stay_end"),
        ROWS,
        F.col(ROWS).alias("_weight"),
    )
    units = sessions.withColumn("_weight", F.lit(1).cast("long")).drop("_window")
    units = units.unionByName(alone, allowMissingColumns=True)
    pieces, _ = stage_pieces(
        units.repartitionByRange(F.col(person).asc_nulls_first()), "sessions"
    )
    order = [
        F.col(person).asc_nulls_first(),
        F.col("_first_day").asc_nulls_first(),
        F.col("_last_day").desc_nulls_last(),
        F.col("_stay_start").asc_nulls_first(),
        F.col("_stay_end").desc_nulls_last(),
    ]
    numbered = stage(running_total(pieces, order, "_weight", "_run"), "sessions")
    by_day = numbered.filter(F.col("_days").isNotNull()).select(
        person, F.explode("_days").alias("_day"), F.col("_run").alias("_id"), "_stay_start", "_stay_end"
    )
    # the sides are as large as the days of all persons at most
    together = groups.join(by_day, [person, "_day"]).select(
        person, start, end, ROWS, F.lit(False).alias("_spread"), "_id", "_stay_start", "_stay_end"
    )
    apart = numbered.filter(F.col("_days").isNull()).select(
        person,
        F.col("_stay_start").alias(start),
        F.col("_stay_end").alias(end),
        ROWS,
        (F.col(ROWS) > 1).alias("_spread"),
        (F.col("_run") - F.col("_weight") + 1).alias("_id"),
        "_stay_start",
        "_stay_end",
    )
    found = together.unionByName(apart).withColumns(
        {
            "_at_first": F.lit(True),
            "_last_start": F.col("_stay_start"),
            "_last_end": F.col("_stay_end"),
        }
    )
    return stage_and_measure(found, "stays", top=F.max(ROWS), spread=F.bool_or("_spread"))


def number_stays(
    df: DataFrame,
    *,
    person: str = "ID_PESSOA",
    start: str = "DT_INTERNACAO_CORRIGIDA",
    end: str = "DT_ALTA_CORRIGIDA",
    link: str = "previous",
    stay: str = "ID_INTERNACAO",
    stay_dates: bool = True,
    out_start: str = "DT_INTERNACAO",
    out_end: str = "DT_ALTA",
    order: Sequence[str] = ("COD_CONTROLE", "NR_LINHA"),
) -> DataFrame:
    """Give every row the number of its stay, and the stay's first and last day.

    ``previous`` links a row to the row before it in order of admission (then
    longest first) when they overlap or lie one day apart; ``running_max`` links
    it to all rows before it, so a short row inside a long one does not end the
    stay. ``session`` gives the stays of ``running_max`` by session windows, where no
    discharge is before its admission (one that is counts as on that day). Stays are numbered 1.. in order of person and admission. Rows alike in
    person and dates that are each a stay of their own are numbered by the columns of
    ``order`` that the table has, then by all others, however the rows arrive.
    """
    keys = [person, start, end]
    given = {stay: "_id", out_start: "_stay_start", out_end: "_stay_end"}
    if not stay_dates:
        given = {stay: "_id"}
    df = df.drop(*given)
    if link == "session":
        groups, seen = _session_groups(df, person, start, end)
    else:
        groups, seen = _stay_groups(df, person, start, end, link)
    # one row per group, so that copies of hot groups are dealt out, spread or not
    firsts = groups.filter("_at_first").select(
        *keys,
        ROWS,
        "_spread",
        "_id",
        (F.col("_id") + F.col(ROWS) - 1).alias("_last_id"),  # of a spread group
        "_stay_start",
        "_stay_end",
        "_last_start",
        "_last_end",
    )
    joined = attach_measured(df, firsts, keys, hot_limit(seen, df), null_safe=True)
    if seen.get("spread"):
        joined = stage(joined, "joined")  # read for both kinds of group
    out = joined.filter(~F.col("_spread")).select(
        *df.columns, *[F.col(c).alias(name) for name, c in given.items()]
    )
    if not seen.get("spread"):
        return out
    order = [c for c in order if c in df.columns]
    order += [c for c in df.columns if c not in order and c not in keys]
    spread = _number_spread(joined.filter("_spread"), keys, order)
    return out.unionByName(
        spread.select(*df.columns, *[F.col(c).alias(name) for name, c in given.items()])
    )


def _number_spread(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Number the copies of rows that are each a stay of their own.

    ``rows`` come with the stays of their group's first and last copy. They are laid out in
    ``order`` by a range shuffle; a copy's place in its group is its place in its piece
    plus the copies in the pieces before, so no group is ever gathered in one task.
    """
    own = rows.columns[: rows.columns.index("_spread")]
    line = [F.col(f"`{c}`").asc_nulls_first() for c in [*keys, *order]]
    edges = ["_last_id", "_stay_start", "_stay_end", "_last_start", "_last_end"]
    laid = rows.select(*own, F.col("_id").alias("_from"), *edges)
    laid = laid.repartitionByRange(*line).sortWithinPartitions(*line)
    # numbered by the task that sorts, so in the order of the sort
    rows = stage(
        laid.withColumn("_row", F.monotonically_increasing_id()).withColumn(
            PIECE, F.spark_partition_id()
        ),
        "spread",
    )
    in_piece = [*keys, PIECE]
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = (
        rows.groupBy(*in_piece)
        .agg(row_count(), F.min("_row").alias("_first_row"))
        .withColumn("_before", F.coalesce(F.sum(ROWS).over(before), F.lit(0)))
    )
    numbered = attach(rows, shift, in_piece, null_safe=True).withColumn(
        "_id", F.col("_from") + F.col("_before") + F.col("_row") - F.col("_first_row")
    )
    # the first copy may end the stay before, the last may begin the one after;
    # copies between them have only their own dates
    first, last = F.col("_id") == F.col("_from"), F.col("_id") == F.col("_last_id")
    return numbered.withColumns(
        {
            f"_stay_{side}": F.when(first, F.col(f"_stay_{side}"))
            .when(last, F.col(f"_last_{side}"))
            .otherwise(F.col(given))
            for side, given in (("start", keys[1]), ("end", keys[2]))
        }
    )


def consolidate_stays(
    df: DataFrame,
    *,
    person: str = "ID_PESSOA",
    start: str = "DT_INTERNACAO",
    end: str = "DT_ALTA",
    event: str = "DT_OCORR_EVENTO",
    link: str = "previous",
    stay: str = "ID_INTERNACAO",
    stay_dates: bool = True,
    mode: str = "observed",
) -> DataFrame:
    """Classify care, repair dates, keep inpatient rows, number their stays.

    The stay's dates replace the raw ones; with ``stay_dates=False`` the raw ones
    are only dropped.
    """
    df = repair_dates(care_type(df), start=start, end=end, event=event, mode=mode)
    df = df.filter(F.col("TIPO_ATENDIMENTO") == INPATIENT).drop(start, end)
    return number_stays(
        df,
        person=person,
        link=link,
        stay=stay,
        stay_dates=stay_dates,
        out_start=start,
        out_end=end,
    )


def stays_preaggregated(
    df: DataFrame,
    *,
    client: str = "COD_CLIENTE",
    start: str = "DT_INTERNACAO",
    end: str = "DT_ALTA",
    event: str = "DT_OCORR_EVENTO",
    stay: str = "ID_INTERNACAO",
    fmt: str | None = None,
) -> DataFrame:
    """The older stay table: one row per (stay, client) with its dates.

    Latest discharge per admission and earliest admission per discharge are taken
    first. A change of client does not raise the number, so (stay, client) is the
    key. ``fmt`` reads the dates; without it they are cast.
    """
    texts = {start, end} - {
        f.name for f in df.schema if isinstance(f.dataType, (DateType, TimestampType))
    }
    if texts:
        df = fill_stay_dates(df, start=start, end=end, event=event)
    latest = df.groupBy(client, start).agg(F.max(end).alias(end))
    earliest = df.groupBy(client, end).agg(F.min(start).alias(start))

    def day(name: str) -> Column:
        return parse_date(name, fmt) if fmt and name in texts else F.col(name).try_cast("date")

    spans = (
        latest.unionByName(earliest)
        .select(
            F.nullif(F.col(client), F.lit(".")).alias(client)
            if dict(df.dtypes)[client] == "string"
            else F.col(client),
            day(start).alias(start),
            day(end).alias(end),
        )
        .distinct()
    )
    s, e = F.col(start), F.col(end)
    order = [s.asc_nulls_last(), e.desc_nulls_first()]
    w = Window.partitionBy(client).orderBy(*order)
    ps, pe = F.lag(start).over(w), F.lag(end).over(w)

    def inside(day: Column, low: Column, high: Column) -> Column:
        return (F.date_add(day, 1) >= low) & (day <= F.date_sub(high, 1))

    touches = (
        (F.col(client).isNotNull() & inside(s, ps, pe))
        | inside(e, ps, pe)
        | inside(ps, s, e)
        | inside(pe, s, e)
    )
    opens = (F.row_number().over(w) > 1) & ~F.coalesce(touches, F.lit(False))
    ranged = spans.repartitionByRange(F.col(client).desc_nulls_first()).withColumn(
        "_adds", opens.cast("long")
    )
    pieces, _ = stage_pieces(ranged, "spans")
    return (
        running_total(pieces, [F.col(client).desc_nulls_first(), *order], "_adds", stay)
        .groupBy(stay, client)
        .agg(F.min(start).alias(start), F.max(end).alias(end))
    )


def readmission_gap(
    df: DataFrame,
    *,
    stay: str = "ID_INTERNACAO",
    out: str = "TEMPO_DESDE_ULTIMA_INTERNACAO",
    within_days: int | None = None,
    within_out: str = "REINTERNACAO",
    **options,
) -> DataFrame:
    """Attach each stay's gap (``options`` as in ``readmission_gaps``).

    ``within_days`` adds a flag for gaps of at most that many days.
    """
    joined = attach(df.drop(out), readmission_gaps(df, stay=stay, out=out, **options), [stay])
    if within_days is None:
        return joined
    return joined.withColumn(within_out, F.coalesce(F.col(out) <= within_days, F.lit(False)))


def readmission_gaps(
    df: DataFrame,
    *,
    stay: str = "ID_INTERNACAO",
    person: str = "ID_PESSOA",
    start: str = "DT_INTERNACAO",
    end: str = "DT_ALTA",
    out: str = "TEMPO_DESDE_ULTIMA_INTERNACAO",
    mode: str = "intended",
    block: int = BLOCK,
) -> DataFrame:
    """Per stay: days between admission and the discharge of the person's stay before.

    ``intended`` leaves the gap of rows without a person NULL; ``observed`` takes
    them all for one person. ``block``: stay numbers that one window looks at; the
    result does not depend on it.
    """
    kept = stage(df.groupBy(stay, person, start, end).agg(row_count()), "stays")
    kept = _lag_in_blocks(kept, person, stay, end, "_before", block)
    if mode == "intended":
        known = F.col(person).isNotNull()
        kept = kept.withColumn("_before", F.when(known, F.col("_before")))
    return kept.select(stay, ROWS, F.abs(days_between("_before", start)).alias(out))


def _lag_in_blocks(
    df: DataFrame, key: str, number: str, value: str, out: str, block: int
) -> DataFrame:
    """The value of the row before, by number, for keys of any size.

    A window sees one block of numbers of a key. The last row of each block is put
    before the key's next block, where it serves the first row as its predecessor.
    ``df`` must be repeatable.
    """
    df = df.withColumn("_block", F.floor(F.col(number) / block))
    # last in the window's order: the highest number, then the earliest value,
    # a missing value counting as earliest
    place = F.struct(F.col(number), F.isnull(value), -F.unix_date(value))
    last = df.groupBy(key, "_block").agg(
        F.max(F.struct(place.alias("place"), F.col(value).alias("v"))).getField("v").alias(value)
    )
    ahead = F.lead("_block").over(Window.partitionBy(key).orderBy("_block"))
    carried = (
        last.select(key, ahead.alias("_block"), value, F.lit(True).alias("_carried"))
        .filter(F.col("_block").isNotNull())
    )
    both = df.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(key, "_block").orderBy(
        F.col("_carried").desc(),
        F.col(number).asc_nulls_first(),
        F.col(value).desc_nulls_last(),
    )
    return (
        both.withColumn(out, F.lag(value).over(w))
        .filter(~F.col("_carried"))
        .drop("_carried", "_block")
    )
