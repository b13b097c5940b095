"""Every registered query: the engine's operators over the given tables.

Each takes a session and a scale-factor folder and returns a DataFrame.  The
queries that need files, a store or a stream keep them in a fresh folder of the
shared folder, all written by Spark from the given tables.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane import catalog
from starlane.contracts import CONTRACTS, table_kind, target_name
from starlane.fixtures import Fixtures
from starlane.functions import casts
from starlane.functions.rows import conform
from starlane.operators import derive, duplicates, enrich, gates, integrity, quality
from starlane.plans import kpi, views
from starlane.plans.drops import load_drop
from starlane.plans.gold import Stages, to_gold
from starlane.plans.load import Loader
from starlane.plans.rollup import Rollup
from starlane.session import materialize, new_folder
from starlane.sinks import files as file_sinks
from starlane.sinks.store import Store
from starlane.sources import files, ledger
from starlane.streaming import reconcile
from starlane.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

BATCH = "b-1"


def _query(run: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register a function of the fixtures under its own name."""

    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(Fixtures(spark, folder))

    QUERIES[run.__name__] = call
    return run


# ---------------------------------------------------------------- shared parts


def _customers_text(fx: Fixtures) -> DataFrame:
    return fx.customers_raw


def _customers(fx: Fixtures) -> DataFrame:
    """Customers that passed the whole gate, which checks them once for all uses."""
    contract = CONTRACTS["customers"]
    return fx.written(
        "clean-customers", lambda: gates.clean_rows(gates.flag_rows(fx.customers_raw, contract), contract)
    )


def _first_customers(fx: Fixtures) -> DataFrame:
    """The earlier customer snapshot, before one market segment was opened."""
    late = fx.segments.filter(F.col("segment_name") == "BUILDING").select("segment_id")
    return _customers(fx).join(late, "segment_id", "left_anti")


def _order_dims(fx: Fixtures, customers: DataFrame) -> dict[str, DataFrame]:
    return {
        "customers": customers,
        "restaurants": fx.restaurants,
        "drivers": fx.drivers,
        "regions": fx.regions,
    }


def _ticket_dims(fx: Fixtures) -> dict[str, DataFrame]:
    return {"priorities": fx.priorities, "channels": fx.channels}


def _gold_tickets(fx: Fixtures) -> DataFrame:
    return to_gold(fx.tickets, "tickets", _ticket_dims(fx), BATCH).drop("ingested_at")


def _gold_regions(fx: Fixtures) -> DataFrame:
    return enrich.enrich(fx.regions, "regions", {"cities": fx.cities})


def _gold_reasons(fx: Fixtures) -> DataFrame:
    return enrich.enrich(
        fx.reasons, "reasons", {"reason_categories": fx.reason_categories}
    )


def _listed(bad: DataFrame) -> DataFrame:
    """Failing columns as text."""
    return bad.withColumn("failed_columns", F.array_join(gates.FAILED, ", ")).drop(
        gates.FAILED
    )


def _store(fx: Fixtures, label: str) -> Store:
    return Store(fx.spark, new_folder(fx.spark, label))


# --------------------------------------------------------------------- sources


@_query
def scan_csv(fx: Fixtures) -> DataFrame:
    path = f"{new_folder(fx.spark, 'scan')}/customers.csv"
    file_sinks.write_csv(fx.customers_raw, path)
    return files.read_csv(fx.spark, path)


@_query
def scan_json(fx: Fixtures) -> DataFrame:
    contract = CONTRACTS["orders"]
    path = f"{new_folder(fx.spark, 'scan')}/orders.json"
    file_sinks.write_json(fx.orders, path)
    text = files.read_json(fx.spark, path, contract.columns)
    return gates.cast_to_contract(text, contract)


@_query
def scan_json_split(fx: Fixtures) -> DataFrame:
    """Half of the orders as arrays, half as keyed objects, read in ranges of 64 KiB."""
    contract = CONTRACTS["orders"]
    root, half = new_folder(fx.spark, "scan"), F.pmod(F.xxhash64("order_id"), F.lit(2))
    file_sinks.write_json(fx.orders.where(half == 0), f"{root}/orders.json")
    file_sinks.write_keyed_json(fx.orders.where(half == 1), "order_id", f"{root}/keyed.json")
    array = files.read_json(fx.spark, f"{root}/orders.json", contract.columns, span=1 << 16)
    keyed = files.read_keyed_json(fx.spark, f"{root}/keyed.json", contract.columns, span=1 << 16)
    return gates.cast_to_contract(array.unionAll(keyed), contract)


@_query
def scan_json_keyed(fx: Fixtures) -> DataFrame:
    path = f"{new_folder(fx.spark, 'scan')}/restaurants.json"
    file_sinks.write_keyed_json(fx.restaurants, "restaurant_id", path)
    text = files.read_keyed_json(fx.spark, path, fx.restaurants.columns)
    return gates.cast_to_contract(text, CONTRACTS["restaurants"])


@_query
def coerce_dates(fx: Fixtures) -> DataFrame:
    return fx.customers_raw.select(
        "customer_id",
        "signup_date",
        casts.to_date(F.col("signup_date")).alias("as_date"),
        casts.to_timestamp(F.col("signup_date")).alias("as_timestamp"),
    )


def _land(fx: Fixtures, root: str) -> list[str]:
    """Drops as they arrive: complete, incomplete, empty, unknown, unsupported."""
    paths = {
        "customers.csv": conform(fx.customers_raw, CONTRACTS["customers"], as_text=True),
        "regions.csv": fx.regions,
        "segments.csv": fx.segments.withColumn("note", F.lit("new")),
        "drivers.csv": fx.drivers,
        "teams.csv": fx.teams.filter(F.col("team_id") < 0),
        "nation.csv": fx.table("nation"),
    }
    for name, df in paths.items():
        file_sinks.write_csv(df, f"{root}/{name}")
    file_sinks.write_json(fx.restaurants, f"{root}/restaurants.json")
    fx.cities.write.parquet(f"{root}/cities.parquet")
    return [f"{root}/{name}" for name in [*paths, "restaurants.json", "cities.parquet"]]


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df)
    return whole


@_query
def scan_dispatch(fx: Fixtures) -> DataFrame:
    found = []
    for path in _land(fx, new_folder(fx.spark, "drops")):
        reader = files.reader_for(path)
        count = (
            reader(fx.spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
            if reader
            else fx.spark.range(1).select(F.lit(None).cast("bigint").alias("n_rows"))
        )
        found.append(
            count.select(
                F.lit(files.table_name(path)).alias("table_name"),
                F.lit(reader is not None).alias("supported"),
                "n_rows",
                (F.col("n_rows") == 0).alias("is_empty"),
            )
        )
    return _union(found)


@_query
def gate_filename(fx: Fixtures) -> DataFrame:
    """Files under a drop folder, accepted by the table their path names."""
    root = new_folder(fx.spark, "drops")
    _land(fx, root)
    known = fx.spark.sql(
        f"SELECT * FROM VALUES {', '.join(repr(t) for t in CONTRACTS)} AS t(table_name)"
    ).withColumn("accepted", F.lit(True))
    tables = (
        files.route(files.list_files(fx.spark, root))
        .filter(F.col("table_name") != "")
        .select("table_name")
        .distinct()
    )
    return tables.join(F.broadcast(known), "table_name", "left").select(
        "table_name", F.coalesce("accepted", F.lit(False)).alias("accepted")
    )


@_query
def gate_columns(fx: Fixtures) -> DataFrame:
    verdicts = []
    for path in _land(fx, new_folder(fx.spark, "drops")):
        reader = files.reader_for(path)
        contract = CONTRACTS.get(files.table_name(path))
        if reader is None or contract is None:
            continue
        df = reader(fx.spark, path)
        verdict = gates.check_columns(df.columns, contract)
        verdicts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(contract.name).alias("table_name"),
                F.lit(verdict.passed).alias("passed"),
                F.lit(verdict.reason).alias("reason"),
                "n_rows",
            )
        )
    return _union(verdicts)


@_query
def gate_schema(fx: Fixtures) -> DataFrame:
    """File name, then columns, then types; the first failure drops the file."""
    verdicts = []
    for path in _land(fx, new_folder(fx.spark, "drops")):
        reader = files.reader_for(path)
        verdict = gates.check_file_name(path)
        counts = [F.lit(None).cast("bigint")] * 2
        one = fx.spark.range(1)
        if reader is None:
            verdict = gates.SchemaVerdict(verdict.table, "unsupported format")
        elif verdict.passed:
            df = reader(fx.spark, path)
            contract = CONTRACTS[verdict.table]
            verdict = gates.check_columns(df.columns, contract)
            if verdict.passed:
                one = df.select(
                    (F.size(gates.type_failures(df, contract)) > 0).alias("bad")
                )
                counts = [F.count_if(~F.col("bad")), F.count_if(F.col("bad"))]
                one = one.agg(counts[0].alias("a"), counts[1].alias("b"))
                counts = [F.col("a"), F.col("b")]
        verdicts.append(
            one.select(
                F.lit(verdict.table).alias("table_name"),
                F.lit(verdict.reason).alias("reason"),
                counts[0].alias("clean_rows"),
                counts[1].alias("bad_rows"),
            )
        )
    return _union(verdicts)


@_query
def route_files(fx: Fixtures) -> DataFrame:
    """Hourly drops by date and hour, found again from their paths alone."""
    root = new_folder(fx.spark, "hourly")
    dated = fx.ticket_events.withColumns(
        {
            "run_date": F.col("event_ts").cast("date").cast("string"),
            "run_hour": F.substring(F.col("event_ts").cast("string"), 12, 2),
            "event_ts": F.col("event_ts").cast("string"),
        }
    )
    dated.write.option("header", True).partitionBy("run_date", "run_hour").csv(
        f"{root}/ticket_events.csv"
    )
    rows = (
        fx.spark.read.schema(CONTRACTS["ticket_events"].text_schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .csv(root)
        .select(F.col("_metadata.file_path").alias("path"))
    )
    per_file = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return (
        files.route(per_file)
        .groupBy("table_name", "run_date", "run_hour")
        .agg(F.sum("n").alias("n_rows"))
    )


@_query
def new_files_by_hash(fx: Fixtures) -> DataFrame:
    """A renamed copy of a processed file is known, a new file is not."""
    root = new_folder(fx.spark, "ledger")
    customers = materialize(fx.customers_raw, "customers")
    file_sinks.write_csv(customers, f"{root}/customers.csv")
    done = ledger.hash_files(fx.spark, f"{root}/customers.csv")
    logged = materialize(ledger.ledger_rows(done, BATCH), "ledger")
    file_sinks.write_csv(customers, f"{root}/customers_resent.csv")
    file_sinks.write_csv(fx.regions, f"{root}/regions.csv")
    hashed = ledger.hash_files(fx.spark, root)
    fresh = ledger.new_files(hashed, logged).select("path", F.lit(True).alias("fresh"))
    datasets = hashed.join(fresh, "path", "left").select(
        files.path_table(F.col("path")).alias("dataset"), "fresh"
    )
    return (
        datasets.filter(F.col("dataset") != "")
        .groupBy("dataset")
        .agg(F.coalesce(F.bool_or("fresh"), F.lit(False)).alias("is_new"))
    )


# ----------------------------------------------------------------------- gates


@_query
def gate_type_bad(fx: Fixtures) -> DataFrame:
    return _listed(gates.split_types(fx.customers_raw, CONTRACTS["customers"]).bad)


@_query
def gate_type_clean(fx: Fixtures) -> DataFrame:
    return gates.split_types(fx.customers_raw, CONTRACTS["customers"]).clean


@_query
def failure_reasons(fx: Fixtures) -> DataFrame:
    contract, raw = CONTRACTS["customers"], fx.customers_raw
    return raw.select(
        "customer_id",
        F.array_join(gates.type_failures(raw, contract), ", ").alias("type_failed"),
        F.array_join(gates.format_failures(raw, contract), ", ").alias("format_failed"),
        F.array_join(gates.null_failures(raw, contract), ", ").alias("null_failed"),
    )


def _format_split(fx: Fixtures) -> gates.Split:
    contract = CONTRACTS["customers"]
    return gates.split_formats(gates.split_types(fx.customers_raw, contract).clean, contract)


def _null_split(fx: Fixtures) -> gates.Split:
    return gates.split_nulls(_format_split(fx).clean, CONTRACTS["customers"])


@_query
def gate_format_bad(fx: Fixtures) -> DataFrame:
    errors = gates.error_rows(
        _format_split(fx).bad, CONTRACTS["customers"], BATCH, F.lit("FORMAT_ERROR"),
        F.array_join(gates.FAILED, ", "),
    )
    return errors.drop("raw_payload")


@_query
def gate_format_clean(fx: Fixtures) -> DataFrame:
    return _format_split(fx).clean


@_query
def gate_null_bad(fx: Fixtures) -> DataFrame:
    errors = gates.error_rows(
        _null_split(fx).bad, CONTRACTS["customers"], BATCH, F.lit("NULL_REQUIRED_COLUMN"),
        F.array_join(gates.FAILED, ", "),
    )
    return errors.drop("raw_payload")


@_query
def gate_null_clean(fx: Fixtures) -> DataFrame:
    return _null_split(fx).clean


@_query
def preview(fx: Fixtures) -> DataFrame:
    """The sample shown after the schema check: five rows in key order."""
    return gate_type_clean(fx).orderBy("customer_id").limit(5)


@_query
def gate_partition_check(fx: Fixtures) -> DataFrame:
    """Good and bad rows of each check add up to its input."""
    flagged = gates.flag_rows(fx.customers_raw, CONTRACTS["customers"])
    kind = F.col(gates.ERROR_TYPE)
    checks = ["TYPE_MISMATCH", "FORMAT_ERROR", "NULL_REQUIRED_COLUMN"]
    rank = F.coalesce(
        *[F.when(kind == name, F.lit(i)) for i, name in enumerate(checks)], F.lit(len(checks))
    )
    counted = flagged.select(rank.alias("rank")).agg(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.count_if(F.col("rank") >= i).alias("input_rows"),
                F.count_if(F.col("rank") == i).alias("bad_rows"),
                F.count_if(F.col("rank") > i).alias("good_rows"),
            ).alias(name)
            for i, name in enumerate(checks)
        ]
    )
    return counted.select(F.inline(F.array(*checks)))


def _quarantined_customers(fx: Fixtures) -> DataFrame:
    contract = CONTRACTS["customers"]
    bad = gates.bad_rows(gates.flag_rows(fx.customers_raw, contract))
    return gates.error_rows(bad, contract, BATCH)


@_query
def quarantine_all(fx: Fixtures) -> DataFrame:
    """Quarantine of a customer file and of an order file, without clock and ids."""
    contract = CONTRACTS["orders"]
    flagged = gates.flag_rows(fx.staged_orders, contract)
    rejected = gates.error_rows(gates.bad_rows(flagged), contract, BATCH)
    sides = integrity.split_orphans(
        gates.clean_rows(flagged, contract), contract, _order_dims(fx, _customers(fx))
    )
    orphans = gates.error_rows(
        sides.charged, contract, BATCH, F.lit("FK_MISSING"), F.col("fk_column"), F.col("dim_name")
    )
    return _union([_quarantined_customers(fx), rejected, orphans]).drop("raw_payload")


@_query
def error_payload(fx: Fixtures) -> DataFrame:
    return _quarantined_customers(fx).select("event_id", "raw_payload")


# ----------------------------------------------------------------------- sinks


@_query
def load_dim_overwrite(fx: Fixtures) -> DataFrame:
    """Two loads of one dimension: the second is what readers get."""
    store = _store(fx, "dims")
    store.write_dimension(_first_customers(fx), "customers", 1)
    store.write_dimension(_customers(fx), "customers", 2)
    return store.dimensions()["customers"]


@_query
def load_fact_append(fx: Fixtures) -> DataFrame:
    """Two batches and a repeat of the second: appended once each."""
    store = _store(fx, "facts")
    delivered = F.col("order_status") == "Delivered"
    first = fx.orders_base.filter(delivered).withColumn("batch_id", F.lit("b-1"))
    second = fx.orders_base.filter(~delivered).withColumn("batch_id", F.lit("b-2"))
    store.write_fact(first, "orders", "b-1")
    store.write_fact(second, "orders", "b-2")
    store.write_fact(second, "orders", "b-2")
    return store.fact("orders")


def _batches(fx: Fixtures) -> dict[str, DataFrame]:
    """Delivered orders in four batches, by what their ids are divided by."""
    place = F.pmod(F.regexp_extract("order_id", r"(\d+)", 1).cast("long"), F.lit(4))
    rows = _stored_orders(fx).withColumn("place", place)
    return {f"b-{k}": rows.where(F.col("place") == k).drop("place") for k in range(4)}


@_query
def load_fact_atomic(fx: Fixtures) -> DataFrame:
    """What readers count before a batch is written again, once it is written, and once it is committed."""
    store = _store(fx, "facts")
    table = store.fact_table("orders")
    delivered = F.col("order_status") == "Delivered"

    def seen(state: str) -> DataFrame:
        return materialize(store.fact("orders").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(delivered).alias("n_delivered")
        ).withColumn("state", F.lit(state)), "seen")

    store.write_fact(fx.orders_base.filter(delivered), "orders", "b-1")
    before = seen("before")
    row = table.stage(fx.orders_base.filter(~delivered), "b-1", ("order_id",))
    written = seen("written")
    table.commit([row])
    return _union([before, written, seen("committed")])


@_query
def fact_after_new_column(fx: Fixtures) -> DataFrame:
    """A batch without the payment method and with whole amounts, then one that has both in full."""
    store = _store(fx, "facts")
    delivered = F.col("order_status") == "Delivered"
    early = fx.orders_base.filter(delivered).drop("payment_method")
    store.write_fact(early.withColumn("order_amount", F.floor("order_amount").cast("int")), "orders", "b-1")
    store.write_fact(fx.orders_base.filter(~delivered), "orders", "b-2")
    return store.fact("orders")


@_query
def fact_after_compaction(fx: Fixtures) -> DataFrame:
    """Batches put together, then one of them replaced by nothing and another by what the first held."""
    store = _store(fx, "facts")
    batches = _batches(fx)
    for name, rows in batches.items():
        store.write_fact(rows, "orders", name)
    store.fact_table("orders").compact()
    store.write_fact(batches["b-1"].limit(0), "orders", "b-1")
    store.write_fact(batches["b-1"], "orders", "b-3")
    return store.fact("orders")


@_query
def dedup_pruned_history(fx: Fixtures) -> DataFrame:
    """Orders that no batch of the store holds, told by the index of its keys."""
    store = _store(fx, "facts")
    for name, rows in _batches(fx).items():
        store.write_fact(rows, "orders", name)
    store.fact_table("orders").compact()
    fresh = materialize(duplicates.first_per_key(fx.orders, ["order_id"]), "fresh")
    known = store.fact_table("orders").known_keys(fresh, ["order_id"], "next")
    return duplicates.split_stored(fresh, known, ["order_id"]).new if known is not None else fresh


# Tables that the engine does not know, as a user declares them.
_DECLARED = """{
  "formats": {"odd_or_low": "^.*[0-8]$"},
  "tables": {
    "deliveries": {
      "kind": "fact",
      "columns": {"l_orderkey": "int", "l_linenumber": "int", "l_suppkey": "int", "l_quantity": "float",
                  "l_shipdate": "timestamp"},
      "primary_key": ["l_orderkey", "l_linenumber"],
      "foreign_keys": {"l_suppkey": "warehouses.s_suppkey"}
    },
    "warehouses": {
      "kind": "dim",
      "columns": {"s_suppkey": "int", "s_name": "string", "s_nationkey": "int"},
      "primary_key": ["s_suppkey"],
      "foreign_keys": {"s_nationkey": "countries.n_nationkey"},
      "formats": {"s_name": "odd_or_low"}
    },
    "countries": {
      "kind": "dim",
      "columns": {"n_nationkey": "int", "n_name": "string"},
      "primary_key": ["n_nationkey"]
    }
  }
}"""


@_query
def declared_table_load(fx: Fixtures) -> DataFrame:
    """Three declared tables through the whole load, in the order of their references."""
    root = new_folder(fx.spark, "declared")
    fx.spark.range(1).select(F.lit(_DECLARED).alias("value")).coalesce(1).write.text(f"{root}/declared")
    sources = {"deliveries": "lineitem", "warehouses": "supplier", "countries": "nation"}
    store = _store(fx, "declared")
    with catalog.declared_tables(catalog.read_declaration(fx.spark, f"{root}/declared")) as declared:
        paths = []
        for name, contract in declared.contracts.items():
            paths.append(f"{root}/drops/{name}.csv")
            # A file of few row groups is few tasks' work to write as text.
            rows = fx.table(sources[name]).select(*contract.columns)
            file_sinks.write_csv(rows.hint("rebalance", *contract.columns), paths[-1])
        catalog.load_in_order(Loader(store), paths, "d-1", 1)
        return store.fact("deliveries").drop("ingested_at", "batch_id")


@_query
def catalog_targets(fx: Fixtures) -> DataFrame:
    """Target and size of each table a load would write; unknown ones as dimensions."""
    tables = {
        "cities": fx.cities, "regions": fx.regions, "segments": fx.segments,
        "teams": fx.teams, "agents": fx.agents, "channels": fx.channels,
        "priorities": fx.priorities, "reason_categories": fx.reason_categories,
        "reasons": fx.reasons, "customers": fx.customers_raw, "drivers": fx.drivers,
        "restaurants": fx.restaurants, "orders": fx.orders, "tickets": fx.tickets,
        "ticket_events": fx.ticket_events, "nation": fx.table("nation"),
    }
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(table_kind(name)).alias("kind"),
                F.lit(target_name(name)).alias("target"),
                "n_rows",
            )
            for name, df in tables.items()
        ]
    )


@_query
def load_drops(fx: Fixtures) -> DataFrame:
    """All dropped files through the whole load, and what became of each."""
    loader = Loader(_store(fx, "drops"))
    outcomes = []
    for seq, path in enumerate(_land(fx, new_folder(fx.spark, "drops")), 1):
        outcome = load_drop(loader, path, f"drop-{seq}", seq)
        outcomes.append(f"('{files.table_name(path)}', '{outcome}')")
    listed = fx.spark.sql(
        f"SELECT * FROM VALUES {', '.join(outcomes)} AS t(table_name, outcome)"
    )
    sizes = _union(
        [
            df.agg(F.count(F.lit(1)).alias("loaded_rows")).withColumn("table_name", F.lit(t))
            for t, df in loader.store.dimensions().items()
        ]
    )
    return listed.join(sizes, "table_name", "left")


@_query
def nan_to_null(fx: Fixtures) -> DataFrame:
    """Missing refunds arrive as not-a-number and are stored as NULL."""
    arrived = F.coalesce("refund_amount", F.lit(float("nan")))
    return fx.tickets.select(
        "ticket_id", casts.nan_to_null(arrived).alias("refund_amount")
    )


# ------------------------------------------------------------------- integrity


@_query
def orphans_orders(fx: Fixtures) -> DataFrame:
    """Orders whose customer is unknown or missing."""
    dims = {"customers": _customers(fx)}
    return integrity.first_missing(fx.orders, CONTRACTS["orders"], dims).select(
        "order_id", "customer_id"
    )


@_query
def orphan_first_fk(fx: Fixtures) -> DataFrame:
    return integrity.first_missing(
        fx.orders, CONTRACTS["orders"], _order_dims(fx, _customers(fx))
    ).select("order_id", "fk_column", "fk_value", "dim_name")


@_query
def orphans_removed(fx: Fixtures) -> DataFrame:
    return integrity.split_orphans(
        fx.staged_orders, CONTRACTS["orders"], _order_dims(fx, _customers(fx))
    ).clean


def _stored_orders(fx: Fixtures) -> DataFrame:
    """Orders loaded by an earlier run: those already delivered."""
    return fx.orders_base.filter(F.col("order_status") == "Delivered")


@_query
def dedup_against_gold(fx: Fixtures) -> DataFrame:
    fresh = duplicates.first_per_key(fx.orders, ["order_id"])
    return duplicates.split_stored(fresh, _stored_orders(fx), ["order_id"]).new


@_query
def dedup_within_batch(fx: Fixtures) -> DataFrame:
    """Order lines sent more than once, on a key of two columns."""
    return duplicates.first_per_key(fx.table("lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def duplicates_found(fx: Fixtures) -> DataFrame:
    """All incoming copies of stored orders, as the check without batch dedup sees them."""
    return duplicates.split_stored(fx.orders, _stored_orders(fx), ["order_id"]).duplicates


@_query
def duplicate_summary(fx: Fixtures) -> DataFrame:
    sides = duplicates.split_stored(fx.staged_orders, _stored_orders(fx), ["order_id"])
    marked = _union(
        [
            sides.new.select(F.lit(False).alias("found")),
            sides.duplicates.select(F.lit(True).alias("found")),
        ]
    )
    return quality.duplicate_summary(marked, "found")


# -------------------------------------------------- enrichment, computed columns


@_query
def enrich_customers(fx: Fixtures) -> DataFrame:
    return enrich.enrich(_customers(fx), "customers", {"segments": fx.segments})


@_query
def enrich_regions(fx: Fixtures) -> DataFrame:
    return _gold_regions(fx)


@_query
def enrich_agents(fx: Fixtures) -> DataFrame:
    return enrich.enrich(fx.agents, "agents", {"teams": fx.teams})


@_query
def enrich_reasons(fx: Fixtures) -> DataFrame:
    return _gold_reasons(fx)


@_query
def enrich_tickets(fx: Fixtures) -> DataFrame:
    return enrich.enrich(fx.tickets, "tickets", _ticket_dims(fx))


@_query
def enrich_missing_dim(fx: Fixtures) -> DataFrame:
    """Tickets before the channels arrived."""
    return enrich.enrich(fx.tickets, "tickets", {"priorities": fx.priorities})


@_query
def audit_inject(fx: Fixtures) -> DataFrame:
    audited = derive.audit(fx.orders_base, BATCH)
    return audited.select(
        "order_id", "batch_id", F.col("ingested_at").isNotNull().alias("has_time")
    )


@_query
def metrics_orders(fx: Fixtures) -> DataFrame:
    return derive.order_metrics(fx.orders).select(
        "order_id",
        "net_revenue",
        "delivery_duration_min",
        "order_date_id",
        "delivered_date_id",
    )


_TICKET_MEASURES = [
    "ticket_id",
    "first_response_min",
    "resolution_min",
    "is_sla_first_breached",
    "is_sla_resolution_breached",
    "is_reopened",
    "revenue_impact",
    "created_date_id",
    "first_response_date_id",
    "resolved_date_id",
]


@_query
def metrics_tickets(fx: Fixtures) -> DataFrame:
    enriched = enrich.enrich(fx.tickets, "tickets", _ticket_dims(fx))
    return derive.ticket_metrics(enriched).select(_TICKET_MEASURES)


@_query
def metrics_tickets_default_sla(fx: Fixtures) -> DataFrame:
    """Tickets that were never joined to priorities: the default limits apply."""
    return derive.ticket_metrics(fx.tickets).select(_TICKET_MEASURES)


@_query
def gold_tickets(fx: Fixtures) -> DataFrame:
    return _gold_tickets(fx)


@_query
def gold_orders(fx: Fixtures) -> DataFrame:
    fresh = duplicates.first_per_key(fx.orders, ["order_id"])
    return to_gold(fresh, "orders", {}, BATCH).drop("ingested_at")


@_query
def custom_stage(fx: Fixtures) -> DataFrame:
    """A user's stage after the built-in ones."""

    def fee_share(df: DataFrame) -> DataFrame:
        fee, amount = F.col("delivery_fee"), F.col("order_amount")
        return df.withColumn("fee_share", F.when(amount > 0, fee / amount))

    stages = Stages().add("orders", fee_share)
    gold = to_gold(fx.orders_base, "orders", {}, BATCH, stages)
    return gold.select("order_id", "net_revenue", "fee_share")


# ------------------------------------------------------------------------ KPIs


@_query
def kpi_total_tickets(fx: Fixtures) -> DataFrame:
    return kpi.total_tickets(_gold_tickets(fx))


@_query
def kpi_sla_breach_rate(fx: Fixtures) -> DataFrame:
    return kpi.sla_breach_rate(_gold_tickets(fx))


@_query
def kpi_avg_times(fx: Fixtures) -> DataFrame:
    return kpi.average_times(_gold_tickets(fx))


@_query
def kpi_reopen_rate(fx: Fixtures) -> DataFrame:
    return kpi.reopen_rate(_gold_tickets(fx))


@_query
def kpi_refund_revenue(fx: Fixtures) -> DataFrame:
    return kpi.refund_and_revenue(_gold_tickets(fx))


@_query
def kpi_tickets_by_city_region(fx: Fixtures) -> DataFrame:
    return kpi.tickets_by_city_region(_gold_tickets(fx), fx.orders_base, _gold_regions(fx))


@_query
def kpi_tickets_by_restaurant(fx: Fixtures) -> DataFrame:
    return kpi.tickets_by_restaurant(_gold_tickets(fx), fx.restaurants)


@_query
def kpi_tickets_by_driver(fx: Fixtures) -> DataFrame:
    return kpi.tickets_by_driver(_gold_tickets(fx), fx.drivers)


@_query
def kpi_complaint_rate(fx: Fixtures) -> DataFrame:
    return kpi.complaint_rate(_gold_tickets(fx), fx.orders_base)


@_query
def kpi_loss_by_reason_category(fx: Fixtures) -> DataFrame:
    return kpi.loss_by_reason_category(_gold_tickets(fx), _gold_reasons(fx))


# ---------------------------------------------------------------- masked views


@_query
def pii_customer(fx: Fixtures) -> DataFrame:
    return views.masked_view(_customers(fx), "customers")


@_query
def pii_driver(fx: Fixtures) -> DataFrame:
    return views.masked_view(fx.drivers, "drivers")


@_query
def pii_agent(fx: Fixtures) -> DataFrame:
    return views.masked_view(fx.agents, "agents")


@_query
def pii_from_store(fx: Fixtures) -> DataFrame:
    """The masked view of customers as loaded, enriched and stored."""
    customers = _loaded_customers(fx).dimensions(["customers"])["customers"]
    return views.masked_view(customers, "customers")


# --------------------------------------------------------------- reconciliation


def _register_orders(fx: Fixtures, store: Store) -> reconcile.Reconciliation:
    """Run 1: orders against the earlier customers; orphans are parked."""
    contract = CONTRACTS["orders"]
    waiting = reconcile.Reconciliation(store, contract)
    sides = integrity.split_orphans(
        fx.staged_orders, contract, _order_dims(fx, _first_customers(fx))
    )
    waiting.register(sides.charged, "r-1", 1)
    return waiting


@_query
def reconciliation_register(fx: Fixtures) -> DataFrame:
    log = _register_orders(fx, _store(fx, "recon")).log()
    return log.drop("updated_at", "seq", "step", "batch_id")


@_query
def retry_pending(fx: Fixtures) -> DataFrame:
    states = _register_orders(fx, _store(fx, "recon")).states()
    return reconcile.retryable(states, "customers").select(
        "event_id", "fk_column", "fk_value", "retry_count", "status"
    )


@_query
def retry_outcomes(fx: Fixtures) -> DataFrame:
    """Run 2: all customers have arrived."""
    states = _register_orders(fx, _store(fx, "recon")).states()
    return reconcile.retry(states, "customers", _customers(fx), 2).select(
        "event_id", "retry_count", "status"
    )


@_query
def replay_union(fx: Fixtures) -> DataFrame:
    """Rows clean in run 1 together with the rows that run 2 replays."""
    contract = CONTRACTS["orders"]
    clean = integrity.split_orphans(
        fx.staged_orders, contract, _order_dims(fx, _first_customers(fx))
    ).clean
    waiting = _register_orders(fx, _store(fx, "recon"))
    moved = reconcile.retry(waiting.states(), "customers", _customers(fx), 2)
    replayed = reconcile.replayed_rows(waiting.parked(), moved)
    return clean.select(contract.columns).unionByName(replayed)


def _retried(fx: Fixtures, runs: int) -> reconcile.Reconciliation:
    waiting = _register_orders(fx, _store(fx, "recon"))
    customers = materialize(_customers(fx).select("customer_id"), "customer-keys")
    for seq in range(2, 2 + runs):
        moved = reconcile.retry(waiting.states(), "customers", customers, seq)
        waiting.append_log(moved, f"r-{seq}")
    return waiting


@_query
def reconciliation_latest(fx: Fixtures) -> DataFrame:
    """State of every parked event after three runs."""
    return _retried(fx, 2).states().select("event_id", "dim_name", "retry_count", "status")


@_query
def reconciliation_compacted(fx: Fixtures) -> DataFrame:
    """The same states: folded after the first run, the second run's batch written twice and folded between."""
    waiting = _register_orders(fx, _store(fx, "recon"))
    waiting.fold()
    customers = materialize(_customers(fx).select("customer_id"), "customer-keys")
    for seq in (2, 3):
        # Kept, since the batch is written again after its events have moved.
        moved = materialize(reconcile.retry(waiting.states(), "customers", customers, seq), "moved")
        waiting.append_log(moved, f"r-{seq}")
        if seq == 2:
            waiting.fold()
            waiting.append_log(moved, f"r-{seq}")
            waiting.fold()
    return waiting.states().select("event_id", "dim_name", "retry_count", "status")


@_query
def retry_dead_letter(fx: Fixtures) -> DataFrame:
    """Events given up after the fifth try."""
    states = _retried(fx, 5).states()
    return states.filter(F.col("status") == "DEAD").select(
        "event_id", "fk_value", "retry_count", "status"
    )


def _load_order_dims(fx: Fixtures, loader: Loader, customers: DataFrame) -> None:
    for table, df in _order_dims(fx, customers).items():
        loader.store.write_dimension(df, table, 1)


def _ticket_references(fx: Fixtures) -> dict[str, DataFrame]:
    return {
        "agents": fx.agents,
        "customers": _customers(fx),
        "restaurants": fx.restaurants,
        "drivers": fx.drivers,
        "reasons": fx.reasons,
        "channels": fx.channels,
        "priorities": fx.priorities,
    }


def _loaded_tickets(fx: Fixtures) -> Store:
    loader = Loader(_store(fx, "tickets"))
    for table, df in _ticket_references(fx).items():
        loader.store.write_dimension(df, table, 1)
    loader.load_fact("tickets", fx.tickets, "t-1", 1)
    return loader.store


@_query
def load_tickets(fx: Fixtures) -> DataFrame:
    """Tickets through the whole load; their order, a fact, is not checked."""
    return _loaded_tickets(fx).fact("tickets").select(
        "ticket_id", "order_id", "customer_id", "agent_id", "priority_id", "channel_name"
    )


@_query
def load_ticket_events(fx: Fixtures) -> DataFrame:
    """Ticket events while only the agents are loaded; their ticket is not checked."""
    loader = Loader(_store(fx, "events"))
    loader.store.write_dimension(fx.agents, "agents", 1)
    loader.load_fact("ticket_events", fx.ticket_events, "e-1", 1)
    return loader.store.fact("ticket_events").select(
        "event_id", "ticket_id", "agent_id", "event_ts", "new_status"
    )


@_query
def orphan_first_fk_tickets(fx: Fixtures) -> DataFrame:
    return integrity.first_missing(
        fx.tickets, CONTRACTS["tickets"], _ticket_references(fx)
    ).select("ticket_id", "fk_column", "fk_value", "dim_name")


@_query
def kpi_from_store(fx: Fixtures) -> DataFrame:
    """Breach rates of the tickets that a load let into the store."""
    return kpi.sla_breach_rate(_loaded_tickets(fx).fact("tickets"))


@_query
def kpi_incremental(fx: Fixtures) -> DataFrame:
    """All KPIs from sums kept by batch: two refreshes, one batch of tickets and half the orders later."""
    store, tickets = _store(fx, "rollup"), _gold_tickets(fx)
    rollup = Rollup(store)
    dealt = F.pmod(F.xxhash64("ticket_id"), F.lit(3))
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    store.write_fact(tickets.where(dealt == 0).where(half == 0), "tickets", "t-0")
    store.write_fact(tickets.where(dealt == 1), "tickets", "t-1")
    store.write_fact(fx.orders_base.where(half == 0), "orders", "o-0")
    rollup.refresh()
    store.write_fact(tickets.where(dealt == 0), "tickets", "t-0")
    store.write_fact(tickets.where(dealt == 2), "tickets", "t-2")
    store.write_fact(fx.orders_base.where(half == 1), "orders", "o-1")
    rollup.refresh()
    dims = {
        "regions": _gold_regions(fx), "restaurants": fx.restaurants, "drivers": fx.drivers,
        "reasons": _gold_reasons(fx),
    }
    parts = []
    for report, df in rollup.reports(dims).items():
        names = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
        group = F.to_json(F.array(*names)) if names else F.lit(None).cast("string")
        for value in [c for c in df.columns if c not in names]:
            kpi_name = F.lit(report if names else value).alias("kpi")
            parts.append(df.select(kpi_name, group.alias("name"), F.col(value).cast("double").alias("value")))
    return reduce(DataFrame.unionAll, parts)


@_query
def late_dimension_replay(fx: Fixtures) -> DataFrame:
    """Orders load first, their customers arrive later, the orders follow."""
    loader = Loader(_store(fx, "late"))
    _load_order_dims(fx, loader, _first_customers(fx))
    loader.load_fact("orders", fx.staged_orders, "orders-1", 1)
    loader.load_dimension("customers", fx.customers_raw, "customers-2", 2)
    return loader.store.fact("orders").drop("ingested_at", "batch_id")


# ------------------------------------------------------------------- streaming


def _land_orders(fx: Fixtures, root: str) -> None:
    """Two drops: orders already delivered, then all others."""
    delivered = F.col("order_status") == "Delivered"
    file_sinks.write_json(fx.staged_orders.filter(delivered), f"{root}/a/orders.json")
    file_sinks.write_json(fx.staged_orders.filter(~delivered), f"{root}/b/orders.json")


def _stream_orders(fx: Fixtures, loader: Loader, root: str) -> None:
    ingest(
        loader, "orders", root, f"{loader.store.root}/checkpoint", max_files=8
    ).awaitTermination()


def _streamed(fx: Fixtures) -> tuple[Loader, str]:
    loader = Loader(_store(fx, "stream"))
    _load_order_dims(fx, loader, _customers(fx))
    drops = new_folder(fx.spark, "drops")
    _land_orders(fx, drops)
    _stream_orders(fx, loader, drops)
    return loader, drops


@_query
def stream_ingest_orders(fx: Fixtures) -> DataFrame:
    loader, _ = _streamed(fx)
    return loader.store.fact("orders").drop("ingested_at", "batch_id")


@_query
def stream_settled_files(fx: Fixtures) -> DataFrame:
    """The same drops by a running stream that takes a file once it has been the same for a second."""
    loader = Loader(_store(fx, "stream"))
    store, drops = loader.store, new_folder(fx.spark, "drops")
    _load_order_dims(fx, loader, _customers(fx))
    _land_orders(fx, drops)
    landed = ledger.hash_files(fx.spark, drops).where("file_size > 0 AND path LIKE '%.json/part-%'")
    expected, end = landed.select("file_hash").distinct().count(), time.time() + 600
    stream = ingest(
        loader, "orders", drops, f"{store.root}/checkpoint", once=False, interval="1 second", settle=1.0
    )
    while store.processed_files().count() < expected:
        if stream.awaitTermination(1) or time.time() > end:
            raise RuntimeError("the stream ended before all files were loaded")
    stream.stop()
    return store.fact("orders").drop("ingested_at", "batch_id")


@_query
def stream_equals_batch(fx: Fixtures) -> DataFrame:
    """Row digests of the streamed and of the batch-loaded table, compared."""
    streamed, _ = _streamed(fx)
    batch = Loader(_store(fx, "batch"))
    _load_order_dims(fx, batch, _customers(fx))
    batch.load_fact("orders", fx.staged_orders, "orders-1", 1)

    def digests(loader: Loader, weight: int) -> DataFrame:
        rows = loader.store.fact("orders").drop("ingested_at", "batch_id")
        return rows.select(
            F.xxhash64(*sorted(rows.columns)).alias("digest"), F.lit(weight).alias("w")
        )

    both = digests(streamed, 1).unionAll(digests(batch, -1))
    per_row = both.groupBy("digest").agg(
        F.sum("w").alias("balance"), F.count_if(F.col("w") == 1).alias("n")
    )
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("streamed_rows"),
        F.count_if(F.col("balance") != 0).alias("differing_rows"),
    )


@_query
def stream_restart_idempotent(fx: Fixtures) -> DataFrame:
    """A restarted stream, with one drop sent again under another name."""
    loader, drops = _streamed(fx)
    delivered = F.col("order_status") == "Delivered"
    file_sinks.write_json(fx.staged_orders.filter(delivered), f"{drops}/c/orders.json")
    _stream_orders(fx, loader, drops)
    return loader.store.fact("orders").drop("ingested_at", "batch_id")


@_query
def stream_gate_files(fx: Fixtures) -> DataFrame:
    """A stream among files that its gates must drop: short, wide, foreign and unnamed ones."""
    loader = Loader(_store(fx, "stream"))
    _load_order_dims(fx, loader, _customers(fx))
    drops = new_folder(fx.spark, "drops")
    _land_orders(fx, f"{drops}/good ones")
    some = fx.staged_orders.filter(F.col("order_status") == "Delivered")
    file_sinks.write_json(some.drop("driver_id"), f"{drops}/short/orders.json")
    file_sinks.write_json(some.withColumn("more", F.lit("x")), f"{drops}/wide/orders.json")
    file_sinks.write_json(some, f"{drops}/foreign/tickets.json")
    file_sinks.write_json(some, f"{drops}/unnamed/parcels.json")
    _stream_orders(fx, loader, drops)
    return loader.store.fact("orders").drop("ingested_at", "batch_id")


@_query
def repeat_after_dimension(fx: Fixtures) -> DataFrame:
    """A batch repeated after the customers it lacked have come: what it held is replaced."""
    loader = Loader(_store(fx, "repeat"))
    _load_order_dims(fx, loader, _first_customers(fx))
    loader.load_fact("orders", fx.staged_orders, "x-1", 1)
    loader.store.write_dimension(_customers(fx), "customers", 2)
    loader.load_fact("orders", fx.staged_orders, "x-1", 1)
    return loader.store.fact("orders").drop("ingested_at", "batch_id")


@_query
def repeat_numeric_batch(fx: Fixtures) -> DataFrame:
    """A batch whose name looks like a number, loaded twice."""
    loader = Loader(_store(fx, "repeat"))
    _load_order_dims(fx, loader, _customers(fx))
    for _ in range(2):
        loader.load_fact("orders", fx.staged_orders, "007", 1)
    return loader.store.fact("orders").drop("ingested_at")


# --------------------------------------------------------------------- quality


def _order_counts(fx: Fixtures) -> DataFrame:
    """One row of counters for a load of all orders."""
    contract = CONTRACTS["orders"]
    flagged = gates.flag_rows(fx.staged_orders, contract)
    sides = integrity.split_orphans(
        gates.clean_rows(flagged, contract), contract, _order_dims(fx, _customers(fx))
    )
    unique = duplicates.first_per_key(sides.clean, ["order_id"])
    verdicts = _union(
        [
            flagged.select(F.coalesce(gates.ERROR_TYPE, F.lit("passed")).alias("v")),
            sides.charged.select(F.lit("orphan").alias("v")),
            sides.clean.select(F.lit("kept").alias("v")),
            unique.select(F.lit("clean").alias("v")),
        ]
    )

    def n(*names: str):
        return F.count_if(F.col("v").isin(*names))

    gate = ["TYPE_MISMATCH", "FORMAT_ERROR", "NULL_REQUIRED_COLUMN"]
    counts = verdicts.agg(
        n("passed", *gate).alias("total_records"),
        (n("kept") - n("clean")).alias("duplicates"),
        n("orphan").alias("orphans"),
        n("NULL_REQUIRED_COLUMN").alias("null_records"),
        n("orphan", *gate).alias("quarantined_records"),
        n("clean").alias("clean_records"),
        F.lit(1).cast("bigint").alias("files_processed"),
        F.lit(0).cast("bigint").alias("files_failed"),
    )
    return quality.with_rates(counts)


@_query
def quality_summary(fx: Fixtures) -> DataFrame:
    return _order_counts(fx)


@_query
def quality_metrics_long(fx: Fixtures) -> DataFrame:
    wide = _order_counts(fx).withColumn("batch_id", F.lit(BATCH))
    return quality.long_form(wide, quality.COUNTERS + quality.RATES, ["batch_id"])


@_query
def null_profile(fx: Fixtures) -> DataFrame:
    return quality.null_profile(fx.tickets, CONTRACTS["tickets"])


@_query
def null_summary(fx: Fixtures) -> DataFrame:
    return quality.null_summary(fx.tickets, CONTRACTS["tickets"])


@_query
def ref_integrity_rate(fx: Fixtures) -> DataFrame:
    ranked = integrity.rank_references(
        fx.orders, CONTRACTS["orders"], _order_dims(fx, _customers(fx))
    )
    return quality.integrity_rate(ranked, F.col(integrity.FK_RANK).isNotNull(), "orders")


@_query
def sla_consistency(fx: Fixtures) -> DataFrame:
    """Stored breach flags, loaded while priorities were missing, against a recomputation."""
    stored = materialize(derive.ticket_metrics(fx.tickets), "tickets")
    return quality.sla_consistency(stored, _gold_tickets(fx), "ticket_id")


@_query
def quality_breaches(fx: Fixtures) -> DataFrame:
    """Measurements of the customer and order files above their thresholds."""
    nulls = quality.null_profile(fx.tickets, CONTRACTS["tickets"]).select(
        F.concat_ws(".", "table_name", "column_name").alias("subject"),
        F.lit("null_percentage").alias("metric"),
        F.col("null_percentage").alias("value"),
    )
    rates = _order_counts(fx).select(
        F.lit("orders").alias("subject"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("orphan_percentage").alias("metric"),
                    F.col("orphan_rate").alias("value"),
                ),
                F.struct(
                    F.lit("duplicate_percentage").alias("metric"),
                    F.col("duplicate_rate").alias("value"),
                ),
                F.struct(
                    F.lit("duplicate_rate").alias("metric"),
                    (F.col("duplicate_rate") / 100.0).alias("value"),
                ),
            )
        ),
    )
    return quality.breaches(nulls.unionByName(rates))


def _loaded_customers(fx: Fixtures) -> Store:
    loader = Loader(_store(fx, "quality"))
    loader.store.write_dimension(fx.segments, "segments", 1)
    loader.load_dimension("customers", fx.customers_raw, "customers-1", 1)
    return loader.store


@_query
def quality_report(fx: Fixtures) -> DataFrame:
    """What the metrics table says about a customer load."""
    metrics = _loaded_customers(fx).metrics()
    return metrics.filter(F.col("metric_name") != "processing_latency_seconds").select(
        "table_name", "metric_name", "metric_value", "metric_details"
    )


@_query
def quality_latency(fx: Fixtures) -> DataFrame:
    """Mean time from a user's first to last event of a type, as batches of one table."""
    spans = fx.table("events").groupBy("user_id", F.col("event_type").alias("table_name"))
    spans = spans.agg(F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"))
    return quality.mean_latency(spans)
