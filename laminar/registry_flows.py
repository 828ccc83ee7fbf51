"""Registered queries of whole flows: versioned silver, incremental loads, the catalog,
schema discovery, stored sketches. Added to ``registry.QUERIES`` and ``registry.ORACLE``."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from laminar import registry as r
from laminar.plans import customer, rfm
from laminar.sources import testdata

RUN_DATE, NEXT_DAY, AS_OF = r.RUN_DATE, r.NEXT_DAY, r.AS_OF


# --------------------------------------------------------------------------- versioned silver

def _on_day(day) -> str:
    return r.SILVER_SQL.replace(
        f"DATE '{RUN_DATE.isoformat()}' AS processing_date,\n         {RUN_DATE.year} AS year, {RUN_DATE.month} AS month, {RUN_DATE.day} AS day",
        f"DATE '{day.isoformat()}' AS processing_date,\n         {day.year} AS year, {day.month} AS month, {day.day} AS day",
    )


@r.register(
    "silver_crash_recovery",
    f"SELECT 'after the stop' AS seen, * FROM ({_on_day(RUN_DATE)}) a\n"
    f"UNION ALL SELECT 'after the next run', * FROM ({_on_day(NEXT_DAY)}) b",
)
def q_silver_crash_recovery(spark, sf_dir):
    """The next day's run stops between writing its files and publishing them (a half
    written manifest stays too): readers see the first day's table. The run after it
    publishes, and what the stop left is removed."""
    from laminar.plans.layers import clean_to_silver
    from laminar.sources import layers, snapshots

    root = r._fresh(spark, "crash")
    path = f"{root}/silver_orders"
    clean = lambda day: clean_to_silver(
        r._bronze(spark, sf_dir), root, "bronze_orders", "job", run_date=day, versioned=True
    )
    clean(RUN_DATE)
    stopped = snapshots.stage(r.cleaning.clean_for_silver(r._bronze(spark, sf_dir), run_date=NEXT_DAY), path, layers.PARTITION_COLUMNS)
    p, fs = layers._file_system(spark, f"{path}/{snapshots.MANIFESTS}/.stopped")
    fs.create(p, True).close()
    after_stop = layers.read_table(spark, path)
    clean(NEXT_DAY)
    if stopped["snapshot"] not in snapshots.vacuum(spark, path, keep=2, grace_seconds=0):
        raise AssertionError("the stopped run's files are still there")
    seen = lambda df, when: df.select(F.lit(when).alias("seen"), "*").drop(*r.CLOCK_COLUMNS)
    return seen(after_stop, "after the stop").unionByName(seen(layers.read_table(spark, path), "after the next run"))


# --------------------------------------------------------------------------- all gold values

# dataset -> (key, sums with at most seven decimals, whole numbers, labels)
GOLD_VALUES = {
    "customer_analytics": (
        "customer_id",
        ("total_amount",),
        ("total_transactions", "days_since_last_transaction"),
        ("customer_segment", "transaction_frequency", "churn_risk"),
    ),
    "product_analytics": (
        "product_id",
        ("total_revenue", "total_quantity_sold"),
        ("total_sales", "unique_customers", "revenue_rank"),
        ("performance_category",),
    ),
    "daily_metrics": (
        "transaction_date",
        ("daily_revenue",),
        ("daily_transaction_count", "daily_unique_customers", "daily_unique_products"),
        (),
    ),
    "monthly_metrics": (
        "year_month",
        ("monthly_revenue", "prev_month_revenue"),
        ("monthly_transaction_count", "monthly_unique_customers", "monthly_unique_products", "year", "month"),
        (),
    ),
    "cohort_analysis": (
        ("cohort_month", "months_since_first_purchase"),
        ("revenue", "retention_rate"),
        ("customers", "transactions", "cohort_size"),
        (),
    ),
    "rfm_customer_segments": (
        "customer_id",
        ("monetary",),
        ("recency", "frequency", "r_score", "f_score", "m_score"),
        ("rfm_score", "customer_segment"),
    ),
}


def _value_rows(name, df):
    """(dataset, key, measure, number, label) of a gold dataset. Sums of doubles and of
    decimals agree at the amounts' seven decimals."""
    key, sums, whole, labels = GOLD_VALUES[name]
    keys = (key,) if isinstance(key, str) else key
    number = lambda c: F.round(F.col(c).cast("double"), 7).cast("decimal(30,7)")
    null_number, null_label = F.lit(None).cast("decimal(30,7)"), F.lit(None).cast("string")
    parts = [F.struct(F.lit(c).alias("measure"), number(c).alias("number"), null_label.alias("label")) for c in (*sums, *whole)]
    parts += [F.struct(F.lit(c).alias("measure"), null_number.alias("number"), F.col(c).alias("label")) for c in labels]
    told = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.select(F.lit(name).alias("dataset"), told.alias("key"), F.inline(F.array(*parts)))


def _value_rows_sql(name: str, sql: str) -> str:
    key, sums, whole, labels = GOLD_VALUES[name]
    keys = (key,) if isinstance(key, str) else key
    measures = [*sums, *whole, *labels]
    numbers = [f"CAST(round(CAST({c} AS DOUBLE), 7) AS DECIMAL(30,7))" for c in (*sums, *whole)] + ["NULL"] * len(labels)
    texts = ["NULL"] * len(sums + whole) + list(labels)
    told = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (
        f"SELECT '{name}' AS dataset, concat_ws('|', {told}) AS key, unnest({measures}) AS measure, "
        f"unnest([{', '.join(numbers)}]) AS number, unnest(CAST([{', '.join(texts)}] AS VARCHAR[])) AS label "
        f"FROM ({sql}) q"
    )


GOLD_ORACLES = {
    "customer_analytics": r._customer_analytics_sql(r.TX),
    "product_analytics": r._product_analytics_sql(r.TX),
    "daily_metrics": r.DAILY_SQL,
    "monthly_metrics": r.MONTHLY_SQL,
    "cohort_analysis": r.COHORT_SQL,
    "rfm_customer_segments": r._rfm_sql(r.RECENCY_STANDARD_SQL),
}
GOLD_VALUES_SQL = "\nUNION ALL\n".join(_value_rows_sql(n, sql) for n, sql in GOLD_ORACLES.items())


def _gold_values(spark, gold_root, day):
    """All six datasets of a run date as rows of values."""
    from laminar.plans.layers import run_partition

    out = None
    for name in GOLD_VALUES:
        df = spark.read.parquet(f"{gold_root}/{name}")
        rows = _value_rows(name, df.where(run_partition(df, day)))
        out = rows if out is None else out.unionByName(rows)
    return out


@r.register("layers_all_values", GOLD_VALUES_SQL)
def q_layers_all_values(spark, sf_dir):
    """The whole flow from bronze on two run dates (versioned silver, exact RFM cuts): the
    values of all six gold datasets of the second day."""
    from laminar.plans.layers import LayerConfig, run_layers

    root = r._fresh(spark, "all-values")
    bronze = {
        "bronze_transactions": testdata.transactions(spark, sf_dir),
        "bronze_customers": testdata.customers(spark, sf_dir),
        "bronze_products": testdata.products(spark, sf_dir),
    }
    r._land(spark, bronze, f"{root}/bronze")
    for day in (RUN_DATE, NEXT_DAY):
        run_layers(
            spark,
            LayerConfig(
                bronze_tables={n: f"{root}/bronze/{n}" for n in bronze},
                silver_root=f"{root}/silver", gold_root=f"{root}/gold",
                transactions_table="silver_transactions", customers_table="silver_customers",
                products_table="silver_products", lineage_path=f"{root}/lineage",
                gate_keys={"silver_transactions": "transaction_id", "silver_customers": "customer_id", "silver_products": "product_id"},
                as_of=AS_OF, run_date=day, relative_error=0.0,
            ),
        )
    return _gold_values(spark, f"{root}/gold", NEXT_DAY)


# --------------------------------------------------------------------------- incremental flow

@r.register("incremental_gold", GOLD_VALUES_SQL)
def q_incremental_gold(spark, sf_dir):
    """S5 in the flow: masters and the earlier orders land and are loaded; then the later
    ones. The second load stops after its batch was published but before the stream's own
    commit, so it is replayed. Gold is read from the completed load: the values of all six
    datasets."""
    from laminar.plans.layers import IncrementalConfig, run_incremental
    from laminar.sources import snapshots
    from laminar.streaming import incremental
    from pyspark.errors import StreamingQueryException

    root = r._fresh(spark, "incremental-gold")
    tx = r._landed(spark, testdata.transactions(spark, sf_dir), f"{root}/arriving")
    middle = tx.select(F.expr("percentile_approx(unix_micros(cast(transaction_date as timestamp)), 0.5)")).scalar()
    early = F.coalesce(F.unix_micros(F.col("transaction_date").cast("timestamp")) < middle, F.lit(False))
    names = {"silver_transactions": "transactions", "silver_customers": "customers", "silver_products": "products"}
    landing = {t: f"{root}/landing/{n}" for t, n in names.items()}
    cfg = IncrementalConfig(
        sources={t: incremental.Source(path) for t, path in landing.items()},
        silver_root=f"{root}/silver", gold_root=f"{root}/gold", checkpoint_root=f"{root}/_checkpoints",
        transactions_table="silver_transactions", customers_table="silver_customers",
        products_table="silver_products", as_of=AS_OF, run_date=RUN_DATE, relative_error=0.0,
    )
    testdata.customers(spark, sf_dir).write.parquet(landing["silver_customers"])
    testdata.products(spark, sf_dir).write.parquet(landing["silver_products"])
    tx.where(early).write.parquet(landing["silver_transactions"])
    run_incremental(spark, cfg)
    tx.where(~early).write.mode("append").parquet(landing["silver_transactions"])

    class Stopped(RuntimeError):
        pass

    def stop(report):
        raise Stopped(f"after version {report['version']} was published")

    table = "silver_transactions"
    try:
        incremental.load_increment(
            spark, landing[table], None, f"{cfg.silver_root}/{table}", f"{cfg.checkpoint_root}/{table}",
            RUN_DATE, versioned=True, after_batch=stop,
        )
    except StreamingQueryException as e:
        if "was published" not in str(e):
            raise
    if snapshots.current_load(spark, cfg.silver_root)["load"] != 1:
        raise AssertionError("a load that stopped was published")
    run_incremental(spark, cfg)
    return _gold_values(spark, cfg.gold_root, RUN_DATE)


# --------------------------------------------------------------------------- catalog flow

def _flow_days_sql() -> str:
    ctes, select = r._customer_analytics_parts(r.TX)
    days = " UNION ALL ".join(
        f"SELECT {d.year} AS year, {d.month} AS month, {d.day} AS day" for d in (RUN_DATE, NEXT_DAY)
    )
    return f"""WITH {ctes}, ca AS ({select}), days AS ({days}),
m AS (SELECT strftime(transaction_date, '%Y-%m') AS ym, count(transaction_id) AS n FROM tx GROUP BY 1)
SELECT 'customers' AS dataset, year, month, day, customer_segment AS name, count(*) AS n
FROM ca, days GROUP BY ALL
UNION ALL SELECT 'months', year, month, day, ym, n FROM m, days
UNION ALL SELECT 'silver', {NEXT_DAY.year}, {NEXT_DAY.month}, {NEXT_DAY.day}, 'silver_transactions', count(*) FROM tx"""


@r.register("catalog_flow", _flow_days_sql())
def q_catalog_flow(spark, sf_dir):
    """Bronze tables found in a database, silver and gold registered by
    name, the run's partitions added, on two run dates; then read by SQL on names alone."""
    from laminar.sources import catalog, layers

    root = r._fresh(spark, "catalog-flow")
    db = f"flow_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/database'")
    bronze = {
        "bronze_transactions": testdata.transactions(spark, sf_dir),
        "bronze_customers": testdata.customers(spark, sf_dir),
        "bronze_products": testdata.products(spark, sf_dir),
    }
    for name, df in bronze.items():
        df.write.parquet(f"{root}/bronze/{name}")
        layers.register_table(spark, f"{db}.{name}", f"{root}/bronze/{name}", partitioned=False)
    for day in (RUN_DATE, NEXT_DAY):
        catalog.run_catalog_layers(
            spark,
            catalog.CatalogConfig(
                db, f"{root}/bronze", f"{root}/silver", f"{root}/gold", as_of=AS_OF, run_date=day,
                keys={"silver_transactions": "transaction_id", "silver_customers": "customer_id", "silver_products": "product_id"},
            ),
        )
    return spark.sql(
        f"""SELECT 'customers' AS dataset, year, month, day, customer_segment AS name, count(*) AS n
        FROM {db}.customer_analytics GROUP BY year, month, day, customer_segment
        UNION ALL SELECT 'months', load_year, load_month, load_day, year_month, monthly_transaction_count
        FROM {db}.monthly_metrics
        UNION ALL SELECT 'silver', year, month, day, 'silver_transactions', count(*)
        FROM {db}.silver_transactions GROUP BY year, month, day"""
    )


# --------------------------------------------------------------------------- schema discovery

@r.register(
    "schema_drift",
    """WITH n AS (SELECT event_id % 3 + 1 AS load, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT * FROM (VALUES
  (2, 'note', 'added', NULL, 'string', NULL),
  (2, 'user_id', 'retyped', 'int', 'bigint', 'bigint'),
  (2, 'value', 'retyped', 'float', 'double', 'double'),
  (3, 'note', 'lost', 'string', NULL, NULL),
  (3, 'event_id', 'retyped', 'bigint', 'string', NULL)) v(load, "column", change, old_type, new_type, widened))
SELECT 'events' AS table_name, CAST(c.load AS BIGINT) AS load, c."column", c.change, c.old_type,
       c.new_type, c.widened, n.n AS rows
FROM c JOIN n ON c.load = n.load""",
)
def q_schema_drift(spark, sf_dir):
    """Events land in three loads whose files differ: the second widens two columns and
    adds one, the third loses it and turns ids into text (which has no common type). The
    changes are found from the footers through the schema-history table."""
    from laminar.sources import schema_drift as drift

    root = r._fresh(spark, "drift")
    events = testdata.table(spark, sf_dir, "events")
    narrow = events.withColumns({"user_id": F.col("user_id").cast("int"), "value": F.col("value").cast("float")})
    noted = events.withColumn("note", F.col("event_type"))
    text_ids = events.withColumn("event_id", F.col("event_id").cast("string"))
    counts = []
    for load, (kind, df) in enumerate([("narrow", narrow), ("noted", noted), ("text", text_ids)], start=1):
        path = f"{root}/landing/{load}-{kind}"
        df.where(events["event_id"] % 3 + 1 == load).write.parquet(path)
        drift.record_schema(spark, f"{root}/schema_history", "events", load, path)
        counts.append(spark.read.parquet(path).agg(F.lit(load).cast("long").alias("load"), F.count(F.lit(1)).alias("rows")))
    rows = counts[0].unionByName(counts[1]).unionByName(counts[2])
    changes = drift.schema_changes(drift.read_history(spark, f"{root}/schema_history"))
    return changes.join(rows, "load")


# --------------------------------------------------------------------------- stored sketches

@r.register(
    "rfm_cuts_kll",
    f"""WITH {r.TX}, {r.RFM_BASE_CTE}
SELECT m.measure, p.probability, (SELECT count(*) FROM base) AS customers, true AS within_error
FROM (SELECT unnest(['recency', 'frequency', 'monetary']) AS measure) m,
     (SELECT unnest(CAST([0.2, 0.4, 0.6, 0.8] AS DOUBLE[])) AS probability) p""",
)
def q_rfm_cuts_kll(spark, sf_dir):
    """A10 from stored, merged sketches: all customers are sketched as they were before the
    latest tenth of the transactions; then only the groups with customers in the rest are
    sketched anew. Per cut: whether its true rank is within the published error (0.05)."""
    root = r._fresh(spark, "sketches")
    path = f"{root}/rfm"
    columns = ("customer_id", "transaction_id", "amount", "transaction_date")
    # read four times: landed, the join is made once
    tx = r._landed(spark, testdata.transactions(spark, sf_dir).select(*columns), f"{root}/transactions")
    late = tx.select(F.expr("percentile_approx(unix_micros(cast(transaction_date as timestamp)), 0.9)")).scalar()
    is_late = F.unix_micros(F.col("transaction_date").cast("timestamp")) > late
    early = r._landed(spark, customer.customer_base(tx.where(~is_late)), f"{root}/early")
    rfm.write_sketches(early, path)
    touched = tx.where(is_late).select(F.pmod(F.xxhash64("customer_id"), F.lit(rfm.SKETCH_GROUPS)).cast("int").alias("g"))
    groups = [row.g for row in touched.distinct().collect()]  # at most SKETCH_GROUPS numbers
    base = r._landed(spark, customer.customer_base(tx), f"{root}/base")
    rfm.write_sketches(base, path, groups)
    cuts = rfm.sketched_cuts(spark.read.parquet(path))
    ranks = rfm.cut_ranks(rfm.rfm_base(tx, base), cuts)
    n, p, error = F.col("customers"), F.col("probability"), rfm.DEFAULT_RELATIVE_ERROR
    within = (F.col("below") <= (p + error) * n) & (F.col("up_to") >= (p - error) * n)
    return ranks.select("measure", "probability", "customers", within.alias("within_error"))


# --------------------------------------------------------------------------- rule state

ITEM_KEYS = ("l_orderkey", ("l_orderkey", "l_suppkey"))


def _state_sql(keys, table: str, seen: str) -> str:
    names = (keys,) if isinstance(keys, str) else keys
    label, listed = ",".join(names), ", ".join(names)
    present = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""SELECT '{seen}' AS seen, unnest(['ColumnCount', 'Completeness', 'Uniqueness']) AS rule,
  unnest([NULL, '{label}', '{label}']) AS "column",
  unnest([(SELECT CAST(count(*) AS DOUBLE) FROM (DESCRIBE lineitem)), non_null / total, singles / non_null]) AS value,
  unnest(CAST([0, 0.95, 0.99] AS DOUBLE[])) AS threshold,
  unnest([true, non_null / total > 0.95, singles / non_null > 0.99]) AS passed
FROM (SELECT CAST(sum(n) AS DOUBLE) AS total, CAST(sum(n) FILTER ({present}) AS DOUBLE) AS non_null,
             CAST(count(*) FILTER (n = 1 AND {present}) AS DOUBLE) AS singles
      FROM (SELECT {listed}, count(*) AS n FROM {table} GROUP BY ALL) g) s"""


FIRST_ITEMS = "(SELECT * FROM lineitem WHERE l_linenumber = 1)"


@r.register(
    "dq_ruleset_incremental",
    "\nUNION ALL\n".join(
        _state_sql(keys, table, seen)
        for keys in ITEM_KEYS
        for table, seen in ((FIRST_ITEMS, "first load"), ("lineitem", "second load"), ("lineitem", "replayed"))
    ),
)
def q_dq_ruleset_incremental(spark, sf_dir):
    """Q1-Q4 merged load by load: the first items of all orders, then the others, which make
    most keys repeated; then the second load once more. Each evaluation reads its load and
    the state, never the table."""
    from laminar.operators import rule_state

    root = r._fresh(spark, "rule-state")
    items = testdata.table(spark, sf_dir, "lineitem")
    first, rest = items.where("l_linenumber = 1"), items.where("l_linenumber <> 1")
    out = None
    for i, keys in enumerate(ITEM_KEYS):
        path = f"{root}/{i}"
        found = [
            ("first load", rule_state.add_load(first, path, keys, "1")),
            ("second load", rule_state.add_load(rest, path, keys, "2")),
        ]
        rule_state.add_load(rest, path, keys, "2")
        found.append(("replayed", rule_state.evaluate(spark, path, keys)))
        for seen, rows in found:
            rows = rows.select(F.lit(seen).alias("seen"), "*")
            out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------------------------------------- SQL table functions

LATER = r.AS_OF + datetime.timedelta(days=45)


def _seen_customers_sql(seen: str, as_of) -> str:
    sql = r._customer_analytics_sql(r.TX).replace(str(r.AS_OF), str(as_of))
    return (
        f"SELECT '{seen}' AS seen, customer_id, total_transactions, days_since_last_transaction, "
        f"customer_segment, churn_risk FROM ({sql}) q"
    )


@r.register(
    "sql_table_function",
    "\nUNION ALL\n".join(
        _seen_customers_sql(seen, day)
        for seen, day in (("run", r.AS_OF), ("next run", LATER), ("run, later", LATER))
    ),
)
def q_sql_table_function(spark, sf_dir):
    """Customer analytics of two run dates, registered by name; SQL calls the functions
    of a run date and of a date of reference."""
    from laminar.sources import catalog, layers, table_functions

    root = r._fresh(spark, "functions")
    db = f"functions_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/database'")
    tx, customers = testdata.transactions(spark, sf_dir), testdata.customers(spark, sf_dir)
    for day, as_of in ((RUN_DATE, AS_OF), (NEXT_DAY, LATER)):
        gold = customer.customer_analytics(customers, tx, as_of=as_of)
        told = layers.write_gold(gold, f"{root}/gold", "customer_analytics", run_date=day)
        values = dict(zip(layers.PARTITION_COLUMNS, (day.year, day.month, day.day)))
        catalog.register_run(spark, f"{db}.customer_analytics", told["path"], values)
    table_functions.register_run_functions(spark, db, ["customer_analytics"])
    table_functions.register_as_of(spark, db)
    columns = "customer_id, total_transactions, days_since_last_transaction, customer_segment, churn_risk"
    return spark.sql(
        f"""SELECT 'run' AS seen, {columns} FROM customer_analytics_on(DATE '{RUN_DATE}')
        UNION ALL SELECT 'next run', {columns} FROM customer_analytics_on(DATE '{NEXT_DAY}')
        UNION ALL SELECT 'run, later', {columns}
        FROM customers_as_of(DATE '{RUN_DATE}', DATE '{LATER}')"""
    )
