"""Warehouse loads and sheet exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopfloor import schemas
from shopfloor.functions.dates import parse_month_first
from shopfloor.operators import inventory, leads, sales, tickets, training
from shopfloor.schemas import conform
from shopfloor.session import materialize
from shopfloor.sinks import current, export_sheet, overwrite_by_day, publish, read_current, write_parts
from shopfloor.sources import read_csv

# Lines of the target ranges, header included, and the headers of
# the chat contact file.
TRAINING_LINES = 50_000
EXPORT_LINES = 1_000_000
MESSAGE_HEADERS = {"Tên": "name", "Phone(raw)": "phone", "Date(raw)": "date"}


@dataclass(frozen=True)
class Load:
    """One target table.

    ``day`` names the column of a day-partitioned one, ``key`` an id that should
    not repeat, ``problem`` a column that says what was wrong with a row (null:
    nothing); rows that have one are kept apart as well.
    """

    frame: DataFrame
    schema: StructType
    day: str | None = None
    key: str | None = None
    problem: str | None = None

    @property
    def rejected_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(self.problem or "problem", StringType())])


def _replace(spark: SparkSession, path: str, load: Load) -> int:
    """Make the frame the current version of its table; returns the rows with a problem.

    They are counted while the rows are written, not in a scan of their own.
    """
    if load.problem is None:
        publish(spark, path, lambda folder: write_parts(conform(load.frame, load.schema), folder, day=load.day))
        return 0
    seen = Observation()
    rows = conform(load.frame, load.rejected_schema).observe(seen, F.count(load.problem).alias("bad"))
    publish(spark, path, lambda folder: write_parts(rows, folder, load.problem, load.day))
    return seen.get["bad"]


def load_warehouse(spark: SparkSession, folder: str, tables: Mapping[str, Load]) -> DataFrame:
    """Replace every table below ``folder``: ``(table, n_rows, n_cols, n_bad, n_repeated)``.

    Each table is switched as a whole once it is written. The tables are written side
    by side, so that the last tasks of one do not keep the cluster from the next; if
    one fails, its old version stays, the others are still switched, and then the
    error is raised. Rows and columns are read
    back from the current versions (footers only, not thrown off by tasks that ran
    twice); ``n_bad`` rows had a problem and are found as the part ``rejected`` of
    their table; ``n_repeated`` keys occur more than once (null: no key is named).
    """

    def replace(name: str) -> int:
        return _replace(spark, f"{folder}/{name}", tables[name])

    def audit(name: str, load: Load, bad: int) -> DataFrame:
        path = f"{folder}/{name}"
        rows = read_current(spark, path, load.schema)
        repeated = F.lit(None).cast("bigint")
        if load.key:
            keys = rows.groupBy(load.key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1))
            repeated = keys.scalar()
        return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(load.schema)).cast("int").alias("n_cols"),
            F.lit(bad).cast("bigint").alias("n_bad"), repeated.alias("n_repeated"),
        )

    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(replace), name) for name in tables]
    rejected = [done.result() for done in running]
    return reduce(DataFrame.unionAll, [audit(*item, bad) for item, bad in zip(tables.items(), rejected)])


@dataclass(frozen=True)
class LeadFiles:
    """Landed CSV files of the funnel.

    ``one_line`` names the files without a line break inside a cell; many tasks
    read such a file, one task each of the others.
    """

    messages: str
    ad_forms: str
    partner_forms: str
    second_partner_forms: str
    shop_forms: str
    one_line: tuple[str, ...] = ()

    def read(self, spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
        return read_csv(spark, getattr(self, name), columns, quoted_breaks=name not in self.one_line)


def lead_funnel(
    spark: SparkSession,
    files: LeadFiles,
    hotline_calls: DataFrame,
    desk_calls: DataFrame,
    hotline: str,
    problems: bool = False,
) -> DataFrame:
    """All lead sources, from landed files and the two call tables, as one table; see ``lead_rows``."""

    def forms(name: str, *extra: str) -> DataFrame:
        df = files.read(spark, name, ["Date", "Name", "Phone", "Email", *extra])
        moment = parse_month_first(F.col("Date"))
        return df.select(
            moment.alias("Date"), "Name", "Phone", "Email", *extra, leads.unreadable(F.col("Date"), moment)
        )

    return leads.lead_union(
        calls=leads.hotline_calls(hotline_calls, hotline),
        messages=files.read(spark, "messages", list(MESSAGE_HEADERS)).withColumnsRenamed(MESSAGE_HEADERS),
        ad_forms=forms("ad_forms"),
        partner_forms=forms("partner_forms", "Gclid"),
        second_partner_forms=forms("second_partner_forms", "Gclid"),
        shop_forms=files.read(spark, "shop_forms", schemas.SHOP_FORM_CSV.names),
        desk_calls=desk_calls,
        problems=problems,
    )


def bad_dates(files: Mapping[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """``(source, n_rows, n_bad)``: date texts that no rule could read, which the load makes null.

    Per source its rows, the name of the text and the parsed value.
    """

    def one(name: str, rows: DataFrame, text: str, parsed: Column) -> DataFrame:
        return rows.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(text).isNotNull() & parsed.isNull()).alias("n_bad"),
        ).select(F.lit(name).alias("source"), "n_rows", "n_bad")

    return reduce(DataFrame.unionAll, [one(name, *parts) for name, parts in files.items()])


def repeated_ids(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(table, n_ids, n_repeated)``: ids that occur more than once where joins expect one row each."""

    def one(name: str, rows: DataFrame, key: str) -> DataFrame:
        return (
            rows.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count(key).alias("n_ids"), F.count_if(F.col("n") > 1).alias("n_repeated"))
            .select(F.lit(name).alias("table"), "n_ids", "n_repeated")
        )

    return reduce(DataFrame.unionAll, [one(name, *parts) for name, parts in tables.items()])


@dataclass(frozen=True)
class Sources:
    """Frames behind the nightly warehouse load; leads with or without their problems."""

    ledger: sales.Ledger
    tickets: DataFrame
    ticket_fields: DataFrame
    field_labels: DataFrame
    call_logs: DataFrame
    leads: DataFrame


def nightly_tables(sources: Sources, rule: sales.SalesRule = sales.SalesRule()) -> dict[str, Load]:
    """The five tables of the nightly load."""
    labels = [tickets.label_table(sources.field_labels, i) for i in (0, 1)]
    fields = tickets.label_custom_fields(tickets.custom_field_codes(sources.ticket_fields), *labels)
    return {
        "sales_order": Load(sales.sales_order(sources.ledger, rule), schemas.SALES_ORDER),
        "tickets": Load(
            tickets.ticket_projection(sources.tickets), schemas.TICKETS, key="care_soft_ticket_id"
        ),
        "ticket_custom_fields": Load(fields, schemas.TICKET_CUSTOM_FIELDS, key="ticket_id"),
        "call_logs": Load(
            tickets.call_log_projection(sources.call_logs), schemas.CALL_LOGS, key="call_id"
        ),
        "leads": Load(
            sources.leads, schemas.LEADS, problem="problem" if "problem" in sources.leads.columns else None
        ),
    }


def load_stock_snapshot(
    lines: DataFrame,
    headers: DataFrame,
    as_of: str,
    path: str,
    rule: inventory.StockRule = inventory.StockRule(),
) -> None:
    """Movement to balance and gaps, one folder per day."""
    snapshot = inventory.stock_snapshot(inventory.stock_movement(lines, headers, as_of, rule))
    overwrite_by_day(snapshot, path, schemas.INVENTORY_VALUATION, "create_date")


def carry_stock_snapshot(
    spark: SparkSession,
    lines: DataFrame,
    headers: DataFrame,
    as_of: str,
    path: str,
    rule: inventory.StockRule = inventory.StockRule(),
) -> None:
    """The same snapshot by what is new since the last run; other days are not touched.

    ``<path>/opening`` is the state: the last closed day and the balances at its
    end. Headers of later local days alone are read; their days are written anew
    below ``<path>/days``, and then the state moves on to the last day that is
    over. The day under way stays open and is written again by the next run. A run
    that failed, or the same ``as_of`` again, repeats the same days.
    """
    closed, opening = None, spark.createDataFrame([], schemas.OPENING_BALANCES)
    folder = current(spark, f"{path}/opening")
    if folder:
        closed = spark.read.parquet(f"{folder}/closed").first()["day"]
        opening = spark.read.schema(schemas.OPENING_BALANCES).parquet(f"{folder}/balances")
    movement = materialize(inventory.stock_movement(lines, headers, as_of, rule, after=closed), "movement")
    snapshot = conform(inventory.carry_forward(opening, movement), schemas.INVENTORY_VALUATION)
    (
        snapshot.hint("rebalance", F.col("create_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("create_date")
        .parquet(f"{path}/days")
    )
    last = inventory.last_closed_day(as_of)
    if closed is not None and last <= closed:
        return

    def write(state: str) -> None:
        inventory.close_day(opening, movement, last).write.parquet(f"{state}/balances")
        spark.createDataFrame([(last,)], "day date").coalesce(1).write.parquet(f"{state}/closed")

    publish(spark, f"{path}/opening", write)


def export_training(responses: DataFrame, path: str) -> int:
    return export_sheet(training.trainer_rows(responses).drop("position"), path, TRAINING_LINES)


def export_leads(calls: DataFrame, path: str) -> int:
    first = schemas.conform(leads.lead_dedup(calls), schemas.LEAD_EXPORT)
    return export_sheet(first, path, EXPORT_LINES)


def export_posts(posts: DataFrame, meta: DataFrame, post_type: str, path: str) -> int:
    rows = schemas.conform(leads.post_meta(posts, meta, post_type), schemas.POST_EXPORT)
    return export_sheet(rows, path, EXPORT_LINES)
