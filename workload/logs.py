"""Monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import period_seconds, size_bytes
from millrace.operators import monitor
from workload import roles
from workload.registry import query, text


@query(
    "provenance_search",
    f"""WITH {roles.PROVENANCE_SQL}
    SELECT * FROM provenance
    WHERE component_type = 'error' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'
    ORDER BY ts DESC, event_id DESC LIMIT 100""",
)
def provenance_search(t):
    return monitor.provenance_search(
        roles.provenance(t), component_type="error", start="2024-01-05", end="2024-01-20"
    )


@query("get_event", f"WITH {roles.PROVENANCE_SQL} SELECT * FROM provenance WHERE event_id = 77")
def get_event(t):
    return monitor.get_event(roles.provenance(t), 77)


@query(
    "history_page",
    """SELECT event_id AS action_id, ts, user_id AS source_id FROM events
    WHERE user_id = 7 ORDER BY ts DESC, event_id DESC LIMIT 20 OFFSET 10""",
)
def history_page(t):
    actions = t.events.select(
        F.col("event_id").alias("action_id"), "ts", F.col("user_id").alias("source_id")
    )
    return monitor.history(actions, limit=20, offset=10, source_id=7)


@query(
    "history_deep_page",
    """SELECT event_id AS action_id, ts, user_id AS source_id FROM events
    ORDER BY ts DESC, event_id DESC LIMIT 50 OFFSET (SELECT count(*) // 2 FROM events)""",
)
def history_deep_page(t):
    """A page in the middle of the whole history, found by counting."""
    actions = t.events.select(
        F.col("event_id").alias("action_id"), "ts", F.col("user_id").alias("source_id")
    )
    return monitor.history(actions, limit=50, offset=actions.count() // 2)


def _bulletins(t):
    return t.events.select(
        F.col("event_id").alias("bulletin_id"),
        "ts",
        F.col("event_type").alias("level"),
        F.col("user_id").alias("source_id"),
        F.col("props").alias("message"),
    )


@query(
    "bulletin_board",
    """SELECT event_id AS bulletin_id, ts, event_type AS level, user_id AS source_id,
           props AS message
    FROM events WHERE event_type IN ('error', 'signup')""",
)
def bulletin_board(t):
    return monitor.bulletins(_bulletins(t), ["error", "signup"])


@query(
    "bulletin_counts",
    """SELECT user_id AS source_id, event_type AS level, count(*) AS bulletins, max(ts) AS latest
    FROM events WHERE event_type IN ('error', 'signup') GROUP BY user_id, event_type""",
)
def bulletin_counts(t):
    return monitor.bulletin_counts(_bulletins(t), ["error", "signup"])


@query(
    "flow_status",
    f"""WITH {roles.QUEUE_SQL}
    SELECT (SELECT count(*) FROM orders) AS components,
           (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS state_f,
           (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS state_o,
           (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS state_p,
           (SELECT count(*) FROM queue) AS queued_count,
           (SELECT CAST(sum(size_bytes) AS BIGINT) FROM queue) AS queued_bytes""",
)
def flow_status(t):
    components = t.orders.select(F.col("o_orderstatus").alias("state"))
    return monitor.flow_status(components, roles.queue(t), ["F", "O", "P"])


@query(
    "queue_status",
    f"""WITH {roles.QUEUE_SQL}
    SELECT connection_id, count(*) AS queued_count,
           CAST(sum(size_bytes) AS BIGINT) AS queued_bytes, min(ts) AS oldest
    FROM queue GROUP BY connection_id""",
)
def queue_status(t):
    return monitor.queue_status(roles.queue(t))


@query(
    "back_pressure",
    f"""WITH {roles.QUEUE_SQL}, connections AS (
      SELECT CAST(s_suppkey AS VARCHAR) AS connection_id,
             CASE WHEN s_suppkey % 3 <> 0 THEN 550 + s_suppkey END AS object_threshold,
             CASE WHEN s_suppkey % 2 = 0
                  THEN (2 + s_suppkey % 3) * 1073741824 END AS size_threshold_bytes
      FROM supplier),
    status AS (SELECT connection_id, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS b
               FROM queue GROUP BY connection_id),
    checked AS (
      SELECT c.connection_id, object_threshold, size_threshold_bytes,
             coalesce(n, 0) AS queued_count, coalesce(b, 0) AS queued_bytes
      FROM connections c LEFT JOIN status s ON c.connection_id = s.connection_id)
    SELECT *, coalesce(queued_count >= object_threshold, false) AS over_count,
           coalesce(queued_bytes >= size_threshold_bytes, false) AS over_bytes,
           coalesce(queued_count >= object_threshold, false)
           OR coalesce(queued_bytes >= size_threshold_bytes, false) AS under_pressure
    FROM checked""",
)
def back_pressure(t):
    key = F.col("s_suppkey")
    connections = t.supplier.select(
        text("s_suppkey").alias("connection_id"),
        F.when(key % 3 != 0, key + 550).alias("object_threshold"),
        F.when(key % 2 == 0, F.concat(text(key % 3 + 2), F.lit(" GB"))).alias("size_threshold"),
    )
    return monitor.back_pressure(roles.queue(t), connections)


def _part_components(t):
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("group_id"),
    )


@query(
    "list_children",
    """SELECT p_partkey AS id, p_name AS name, p_type AS type, p_brand AS group_id
    FROM part WHERE p_brand = 'Brand#12'""",
)
def list_children(t):
    return monitor.list_children(_part_components(t), "Brand#12")


@query(
    "get_by_id",
    """SELECT p_partkey AS id, p_name AS name, p_type AS type, p_brand AS group_id
    FROM part WHERE p_partkey = 42""",
)
def get_by_id(t):
    return monitor.get_by_id(_part_components(t), 42)


@query(
    "search_components",
    """SELECT p_partkey AS id, p_name AS name, p_type AS type, p_brand AS group_id
    FROM part WHERE contains(lower(p_name), 'widget') OR contains(lower(p_type), 'widget')
       OR contains(lower(p_brand), 'widget')""",
)
def search_components(t):
    return monitor.search_components(
        _part_components(t), " Widget", cols=["name", "type", "group_id"]
    )


@query(
    "search_components_indexed",
    """WITH found AS (SELECT p_partkey AS id, p_name AS name, p_type AS type, p_brand AS group_id,
                          lower(p_name || chr(0) || p_type || chr(0) || p_brand) AS texts FROM part)
    SELECT 'widget' AS query, id, name, type, group_id FROM found WHERE contains(texts, 'widget')
    UNION ALL SELECT '#1', id, name, type, group_id FROM found WHERE contains(texts, '#1')""",
)
def search_components_indexed(t):
    """A longer and a very short text, from one index."""
    components, cols = _part_components(t), ["name", "type", "group_id"]
    index = monitor.index_components(components, cols)
    found = [
        monitor.search_components_indexed(components, index, text, cols).select(F.lit(text).alias("query"), "*")
        for text in ("widget", "#1")
    ]
    return found[0].union(found[1])


@query(
    "search_components_scoped",
    f"""WITH {roles.GROUPS_SQL}
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS type, 'n' || c_nationkey AS group_id
    FROM customer
    WHERE (contains(lower(c_name), 'mach') OR contains(lower(c_mktsegment), 'mach'))
      AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""",
)
def search_components_scoped(t):
    components = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("type"),
        F.concat(F.lit("n"), "c_nationkey").alias("group_id"),
    )
    return monitor.search_components(components, "mach", group_id="r1", groups=roles.groups(t))


@query(
    "parse_sizes",
    """SELECT p_partkey,
      CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS BIGINT) WHEN 1 THEN p_size * 1024::BIGINT
        WHEN 2 THEN p_size * 1048576::BIGINT WHEN 3 THEN p_size * 1073741824::BIGINT END AS bytes,
      CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS BIGINT) WHEN 1 THEN p_size * 60::BIGINT
        WHEN 2 THEN p_size * 3600::BIGINT WHEN 3 THEN p_size * 86400::BIGINT END AS seconds
    FROM part""",
)
def parse_sizes(t):
    def with_unit(*units):
        unit = F.element_at(
            F.array(*[F.lit(u) for u in units]), (F.col("p_partkey") % 5 + 1).cast("int")
        )
        return F.concat(text("p_size"), F.lit(" "), unit)

    return t.part.select(
        "p_partkey",
        size_bytes(with_unit("B", "KB", "MB", "GB", "x")).alias("bytes"),
        period_seconds(with_unit("sec", "min", "hours", "days", "* * * *")).alias("seconds"),
    )
