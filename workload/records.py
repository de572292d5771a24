"""Record transforms and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import records as r
from millrace.operators import routing
from workload import roles
from workload.registry import query, text


@query(
    "update_attribute",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, upper(event_type) AS type,
           CAST(user_id AS VARCHAR) AS "user", CAST(3 AS INTEGER) AS n FROM events""",
)
def update_attribute(t):
    updated = r.update_attributes(
        roles.attributes(t), {"type": "upper(attributes['type'])", "user": F.col("user_id")}
    )
    entry = lambda k: F.col("attributes")[k].alias(k)
    return updated.select(
        "event_id", entry("k"), entry("type"), entry("user"), F.size("attributes").alias("n")
    )


@query(
    "update_record",
    """SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, lower(o_orderstatus) AS status,
           o_custkey AS customer_key, 'P' || left(o_orderpriority, 1) AS customer_rank,
           '2:4' AS items
    FROM orders""",
)
def update_record(t):
    rows = t.orders.select(
        "o_orderkey",
        "o_totalprice",
        "o_orderdate",
        F.struct(
            F.col("o_custkey").alias("key"),
            F.lit("x").alias("rank"),
            F.col("o_orderstatus").alias("status"),
        ).alias("customer"),
        F.col("o_orderpriority").alias("priority"),
        F.array(
            F.struct(F.lit(1).alias("n"), F.lit("a").alias("tag")),
            F.struct(F.lit(2).alias("n"), F.lit("b").alias("tag")),
        ).alias("items"),
    )
    updated = r.update_record(
        rows,
        {
            "o_totalprice": "o_totalprice * 2",
            "o_orderdate": None,
            "status": "lower(customer.status)",
            "customer.rank": "concat('P', left(priority, 1))",
            "customer.status": None,
            "items[].n": "item.n * 2",
            "items[].tag": None,
        },
    )
    return updated.select(
        "o_orderkey",
        "o_totalprice",
        "status",
        F.col("customer.key").alias("customer_key"),
        F.col("customer.rank").alias("customer_rank"),
        F.array_join("items.n", ":").alias("items"),
    )


@query(
    "replace_text",
    """SELECT doc_id, regexp_replace(text, '[0-9]+', '<number>', 'g') AS text FROM documents""",
)
def replace_text(t):
    return r.replace_text(t.documents.select("doc_id", "text"), "text", "[0-9]+", "<number>")


@query(
    "restructure_json",
    """SELECT event_id, '{"attr":{"k":' || json_extract_string(props, '$.k')
           || ',"source":"events"},"unit":"ms"}' AS props,
           '{"k":' || json_extract_string(props, '$.k') || ',"source":"events"}' AS opened
    FROM events WHERE event_id % 10 > 1
    UNION ALL SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '{"k": oops' END, props
    FROM events WHERE event_id % 10 < 2""",
)
def restructure_json(t):
    text = F.when(F.col("event_id") % 10 == 0, '{"k": oops').when(F.col("event_id") % 10 > 1, F.col("props"))
    shaped = r.restructure_json(
        t.events.select("event_id", text.alias("props"), F.col("props").alias("opened")),
        "props",
        [
            {"op": "shift", "fields": {"k:int": "attr.k", "missing": "attr.gone"}},
            {"op": "default", "fields": {"attr.source": "events", "unit": "ms"}},
            {"op": "remove", "fields": ["attr.gone"]},
        ],
    )
    opened = r.restructure_json(
        shaped["success"],
        "opened",
        [
            {"op": "default", "fields": {"source": "events", "k": 0, "spare": [1]}},
            {"op": "remove", "fields": ["spare"]},
        ],
    )
    return opened["success"].unionByName(shaped["failure"])


@query(
    "convert_record",
    """SELECT event_id,
           CASE WHEN event_id % 10 = 0 THEN '{"k": oops' ELSE json_extract_string(props, '$.k') END
             AS text,
           CASE WHEN event_id % 10 = 0 THEN 'failure' ELSE 'success' END AS outcome
    FROM events""",
)
def convert_record(t):
    dirty = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, '{"k": oops').otherwise(F.col("props")).alias("text"),
    )
    routes = r.convert_records(dirty, "text", "json", "csv", "k int")
    return routes["success"].withColumn("outcome", F.lit("success")).unionByName(
        routes["failure"].drop("reason").withColumn("outcome", F.lit("failure"))
    )


@query(
    "convert_record_from_csv",
    """SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS text
    FROM events""",
)
def convert_record_from_csv(t):
    lines = t.events.select("event_id", F.concat_ws(",", "user_id", "event_type").alias("text"))
    schema = "user_id bigint, event_type string"
    return r.convert_records(lines, "text", "csv", "json", schema)["success"]


@query(
    "split_record",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate,
           CAST(floor((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey,
             l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1) / 100) AS BIGINT) AS batch
    FROM lineitem""",
)
def split_record(t):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    lines = t.lineitem.select("l_suppkey", *order)
    slices = F.date_trunc("month", "l_shipdate")
    return r.split_records(lines, "l_suppkey", order, 100, slices).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "batch"
    )


@query(
    "query_record",
    """SELECT event_type, count(*) AS n FROM events WHERE value > 20 GROUP BY event_type""",
)
def query_record(t):
    return r.query_record(
        t.events,
        "SELECT event_type, count(*) AS n FROM {records} WHERE value > :least GROUP BY event_type",
        {"least": 20},
    )


def _same_sql(name: str, sql: str, *tables: str):
    """One text that both engines run; ``{table}`` is a frame here and a table there."""

    @query(name, sql.format(**{x: x for x in tables}))
    def run(t):
        return r.query_record({x: getattr(t, x) for x in tables}, sql)


_same_sql(
    "query_record_agg",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
         round(sum(l_extendedprice), 2) AS sum_price, round(avg(l_discount), 4) AS avg_discount,
         count(*) AS n, count(DISTINCT l_suppkey) AS suppliers
       FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '2000-09-02 00:00:00'
       GROUP BY l_returnflag, l_linestatus""",
    "lineitem",
)
_same_sql(
    "query_record_join",
    """SELECT n_name, o_orderpriority, count(*) AS n,
         round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
       FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
       JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
       WHERE o_orderstatus = 'F' GROUP BY n_name, o_orderpriority""",
    "lineitem", "orders", "customer", "nation",
)
_same_sql(
    "query_record_semi_anti",
    """SELECT c_custkey, c_name FROM {customer} c
       WHERE EXISTS (SELECT 1 FROM {orders} o
                     WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
         AND NOT EXISTS (SELECT 1 FROM {orders} o
                     WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)""",
    "customer", "orders",
)
_same_sql(
    "query_record_rollup",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total,
         CAST(grouping(o_orderpriority) AS INTEGER) AS is_total
       FROM {orders} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    "orders",
)
_same_sql(
    "query_record_window",
    """SELECT event_id, user_id,
         CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT)
           AS nth,
         lag(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS previous,
         max(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id
                          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent_max
       FROM {events}""",
    "events",
)
_same_sql(
    "query_record_topk",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "orders",
)
_same_sql(
    "query_record_setops",
    """SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'F'
       INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P'
       EXCEPT SELECT c_custkey FROM {customer} WHERE c_acctbal < 0
       UNION SELECT n_nationkey FROM {nation}""",
    "orders", "customer", "nation",
)
_same_sql(
    "query_record_scalar",
    """SELECT p_partkey, upper(p_name) AS name, CAST(length(p_type) AS INTEGER) AS type_length,
         CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size_class,
         coalesce(nullif(p_brand, 'Brand#1'), 'first') AS brand,
         round(p_retailprice / 3, 2) AS third, abs(p_size - 25) AS distance,
         substring(p_name, 1, 3) AS short_name, replace(p_name, ' ', '_') AS slug
       FROM {part}""",
    "part",
)


@query(
    "route_on_attribute",
    """SELECT 'errors' AS relationship, event_id FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'large', event_id FROM events WHERE value > 50
    UNION ALL SELECT 'unmatched', event_id FROM events
      WHERE event_type <> 'error' AND NOT coalesce(value > 50, false)""",
)
def route_on_attribute(t):
    return routing.label_on_attribute(
        t.events, {"errors": "event_type = 'error'", "large": "value > 50"}
    ).select("relationship", "event_id")


@query(
    "route_first_match",
    """SELECT CASE WHEN event_type = 'error' THEN 'errors' WHEN value > 50 THEN 'large'
             ELSE 'unmatched' END AS relationship, event_id FROM events""",
)
def route_first_match(t):
    return routing.label_on_attribute(
        t.events, {"errors": "event_type = 'error'", "large": "value > 50"}, mode="first"
    ).select("relationship", "event_id")


@query(
    "route_on_content",
    """SELECT 'script' AS relationship, page_id, url FROM pages
      WHERE regexp_matches(html, '<script[^>]*>')
    UNION ALL SELECT 'list', page_id, url FROM pages WHERE regexp_matches(html, '<li>.*</li>')
    UNION ALL SELECT 'unmatched', page_id, url FROM pages
      WHERE NOT regexp_matches(html, '<script[^>]*>') AND NOT regexp_matches(html, '<li>.*</li>')""",
)
def route_on_content(t):
    return routing.label_on_content(
        t.pages, "html", {"script": "<script[^>]*>", "list": "<li>.*</li>"}
    ).select("relationship", "page_id", "url")


@query(
    "split_outcome",
    """SELECT event_id, raw, try_cast(raw AS INTEGER) AS parsed,
           CASE WHEN try_cast(raw AS INTEGER) IS NULL THEN 'not a number: ' || raw END AS reason
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN event_type
            ELSE json_extract_string(props, '$.k') END AS raw FROM events)""",
)
def split_outcome(t):
    raw = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.get_json_object("props", "$.k")
    )
    rows = t.events.select("event_id", raw.alias("raw")).withColumn(
        "parsed", F.col("raw").try_cast("int")
    )
    return routing.label_outcome(
        rows, "parsed IS NOT NULL", F.concat(F.lit("not a number: "), "raw")
    ).drop("relationship")


@query(
    "fan_in_out",
    """SELECT event_id, value, CAST(NULL AS VARCHAR) AS kind FROM events WHERE event_type = 'view'
    UNION ALL SELECT event_id, NULL, 'copy' FROM events WHERE event_type = 'view'
    UNION ALL SELECT event_id, NULL, 'click' FROM events WHERE event_type = 'click'""",
)
def fan_in_out(t):
    routes = routing.route_on_attribute(
        t.events, {"views": "event_type = 'view'", "clicks": "event_type = 'click'"}
    )
    return routing.fan_in(
        [
            routes["views"].select("event_id", "value"),
            routes["views"].select("event_id", F.lit("copy").alias("kind")),
            routes["clicks"].select("event_id", F.lit("click").alias("kind")),
        ]
    )


@query(
    "wait_notify",
    """WITH sums AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase'
                  GROUP BY user_id)
    SELECT event_id, e.user_id, coalesce(n, 0) AS signals,
           CASE WHEN coalesce(n, 0) >= 15 THEN 'released' ELSE 'waiting' END AS state
    FROM events e LEFT JOIN sums USING (user_id) WHERE event_type = 'signup'""",
)
def wait_notify(t):
    events = t.events.select("event_id", "user_id", "event_type")
    return routing.label_wait_notify(
        events.where("event_type = 'signup'").drop("event_type"),
        events.where("event_type = 'purchase'"),
        "user_id",
        15,
        name="state",
    )


@query(
    "split_record_text",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_returnflag,
           CAST((row_number() OVER (PARTITION BY l_suppkey
             ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1) // 100 AS BIGINT) AS batch
    FROM lineitem""",
)
def split_record_text(t):
    """A text as order column, of which a supplier has thousands of rows alike; slices are measured."""
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    order = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return r.split_records(lines, "l_suppkey", order, 100).drop("l_extendedprice")


@query(
    "wait_notify_timeout",
    """WITH moves AS (SELECT event_id, user_id, event_type, epoch_ms(ts) AS ms FROM events
              WHERE event_type IN ('signup', 'purchase'))
    SELECT w.event_id, w.user_id, count(s.event_id) AS signals,
           CASE WHEN count(s.event_id) >= 2 THEN 'released' ELSE 'expired' END AS outcome
    FROM moves w LEFT JOIN moves s ON s.user_id = w.user_id
      AND s.event_type = 'purchase' AND abs(s.ms - w.ms) <= 86400000
    WHERE w.event_type = 'signup' GROUP BY w.event_id, w.user_id""",
)
def wait_notify_timeout(t):
    events = t.events.select("event_id", "user_id", "event_type", "ts")
    signups = events.where("event_type = 'signup'").drop("event_type")
    purchases = events.where("event_type = 'purchase'")
    return routing.label_wait_notify_timeout(signups, purchases, "user_id", 2, 24 * 3600).drop("ts")


@query(
    "log_attribute",
    """SELECT count(*) AS rows, count(DISTINCT event_type) AS types, max(event_id) AS last
    FROM events""",
)
def log_attribute(t):
    measured, observation = routing.log_attributes(
        t.events.select("event_id", "event_type"),
        "events",
        {
            "rows": "count(*)",
            "types": "cast(size(collect_set(event_type)) as bigint)",
            "last": "max(event_id)",
        },
    )
    measured.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([observation.get], "rows bigint, types bigint, last bigint")
