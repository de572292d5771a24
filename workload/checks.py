"""Definitions: parse, default, check, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import blank_to_null, split_list
from millrace.operators import definitions as d
from millrace.operators import validate as v
from workload import roles
from workload.registry import query, text

PROCESSORS_SQL = """processors AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS pipeline_id, l_linenumber AS pos,
         CAST(l_linenumber AS VARCHAR) AS name,
         CASE WHEN p_size < 5 THEN '' ELSE p_type END AS type
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
EDGES_SQL = """edges AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS pipeline_id, l_linenumber AS pos,
         CAST(l_linenumber AS VARCHAR) AS source, CAST(l_linenumber + 1 AS VARCHAR) AS destination,
         l_returnflag = 'R' AS unrelated FROM lineitem)"""
NAMES_SQL = """names AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS pipeline_id,
         CAST(l_linenumber AS VARCHAR) AS name FROM lineitem)"""


def _documents(t):
    """A definition for each order, with its lines as processors and edges; some are broken."""
    item = F.struct("name", F.concat(F.lit("org.example."), "type").alias("type"))
    edge = F.struct("source", "destination", F.when(F.size("relationships") == 0, F.col("relationships")).alias("relationships"))
    docs = d.nest_documents(
        roles.pipelines(t),
        "pipeline_id",
        {"name": F.col("name")},
        {
            "processors": (roles.processors(t), F.col("pos"), item),
            "connections": (roles.edges(t), F.col("pos"), edge),
        },
    )
    key = F.col("pipeline_id").cast("bigint") % 50
    broken = (
        F.when(key == 0, "{broken")
        .when(key == 1, " \t ")
        .when(key == 2, "[]")
        .when(key == 3, '{"name":"x","processors":[{"name":"a"}]}')
        .when(key == 4, '{"name":"x","connections":[{"source":"a"}]}')
        .when(key == 5, '{"name":"x","controllerServices":[7]}')
        .when(key == 6, '{"name":"x","parameterContexts":[{}]}')
        .otherwise(F.col("document"))
    )
    return docs.select("pipeline_id", broken.alias("document"))


@query(
    "round_trip_definitions",
    f"""WITH {PROCESSORS_SQL}
    SELECT pipeline_id,
           CAST(row_number() OVER (PARTITION BY pipeline_id ORDER BY pos, type) - 1 AS INTEGER)
             AS pos,
           name, 'org.example.' || type AS type, o_clerk AS pipeline
    FROM processors JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, o_orderpriority AS o_clerk FROM orders)
    USING (pipeline_id)""",
)
def round_trip_definitions(t):
    """Written in parts of two children, most definitions in several, and joined again."""
    item = F.struct("name", F.concat(F.lit("org.example."), "type").alias("type"))
    docs = d.nest_documents(
        t.orders.select(F.col("o_orderkey").cast("string").alias("pipeline_id"), "o_orderpriority"),
        "pipeline_id",
        {"name": F.col("o_orderpriority")},
        {"processors": (roles.processors(t), F.col("pos"), item)},
        part_rows=2,
    )
    again = d.parse_definitions(docs, "pipeline_id", "document", "part")
    return again.processors.join(again.pipelines.withColumnRenamed("name", "pipeline"), "pipeline_id").select(
        "pipeline_id", "pos", "name", "type", "pipeline"
    )


@query(
    "parse_definitions",
    f"""WITH {PROCESSORS_SQL}
    SELECT pipeline_id,
           CAST(row_number() OVER (PARTITION BY pipeline_id ORDER BY pos, type) - 1 AS INTEGER)
             AS pos,
           name, 'org.example.' || type AS type, CAST(0 AS INTEGER) AS n_properties
    FROM processors WHERE CAST(pipeline_id AS BIGINT) % 50 > 6""",
)
def parse_definitions(t):
    parsed = d.parse_definitions(_documents(t), "pipeline_id", "document")
    return parsed.processors.select(
        "pipeline_id", "pos", "name", "type", F.size("properties").alias("n_properties")
    )


@query(
    "parse_definitions_edges",
    f"""WITH {EDGES_SQL}
    SELECT pipeline_id, source, destination,
           CASE WHEN unrelated THEN '' ELSE 'success' END AS relationships
    FROM edges WHERE CAST(pipeline_id AS BIGINT) % 50 > 6""",
)
def parse_definitions_edges(t):
    parsed = d.parse_definitions(_documents(t), "pipeline_id", "document")
    return parsed.connections.select(
        "pipeline_id", "source", "destination", F.array_join("relationships", ",").alias("relationships")
    )


@query(
    "parse_definitions_rejects",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id,
      CASE o_orderkey % 50 WHEN 0 THEN '{d.REASON_NOT_OBJECT}' WHEN 1 THEN '{d.REASON_BLANK}'
        WHEN 2 THEN '{d.REASON_NO_NAME}' WHEN 3 THEN '{d.REASON_PROCESSOR}'
        WHEN 4 THEN '{d.REASON_CONNECTION}' WHEN 5 THEN '{d.REASON_SERVICE}'
        WHEN 6 THEN '{d.REASON_CONTEXT}' END AS reason
    FROM orders WHERE o_orderkey % 50 <= 6""",
)
def parse_definitions_rejects(t):
    return d.parse_definitions(_documents(t), "pipeline_id", "document").rejects


@query(
    "default_names",
    """SELECT p_partkey, CASE WHEN p_size < 10 THEN '' WHEN p_size < 25 THEN p_name
             WHEN p_size < 40 THEN p_type ELSE 'org.example.' END AS name,
           CASE WHEN p_partkey % 3 = 0 THEN 'success' ELSE 'a,b' END AS relationships
    FROM part""",
)
def default_names(t):
    size = F.col("p_size")
    components = t.part.select(
        "p_partkey",
        F.when(size < 10, "").when(size < 25, F.col("p_name")).alias("name"),
        F.when(size < 40, F.concat(F.lit("org.example."), "p_type"))
        .otherwise("org.example.")
        .alias("type"),
        F.when(F.col("p_partkey") % 3 != 0, F.array(F.lit("a"), F.lit("b"))).alias("relationships"),
    )
    return d.normalise_components(components).select(
        "p_partkey", "name", F.array_join("relationships", ",").alias("relationships")
    )


@query(
    "clean_lists",
    """SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL ELSE p_name END AS given,
           p_brand || '||' || p_name AS kept, p_brand || '|' || p_name AS dropped FROM part""",
)
def clean_lists(t):
    listed = F.concat(F.lit(" "), "p_brand", F.lit(",\t ,"), "p_name", F.lit("\n"))
    name = F.when(F.col("p_size") < 5, " \n ").otherwise(F.concat(F.lit("\t"), "p_name", F.lit(" ")))
    return t.part.select(
        "p_partkey",
        blank_to_null(name).alias("given"),
        F.array_join(split_list(listed), "|").alias("kept"),
        F.array_join(split_list(listed, drop_blank=True), "|").alias("dropped"),
    )


@query(
    "first_by_name",
    """SELECT l_orderkey, l_linenumber, arg_min(l_partkey, l_partkey * 100000 + l_suppkey)
             AS l_partkey,
           arg_min(l_suppkey, l_partkey * 100000 + l_suppkey) AS l_suppkey
    FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def first_by_name(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return d.first_by_name(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query(
    "check_empty",
    """SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, 'flow-' || o_orderkey AS name FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def check_empty(t):
    lines = t.lineitem.select(text("l_orderkey").alias("pipeline_id"))
    return v.empty_parents(roles.pipelines(t), lines, "pipeline_id")


@query(
    "check_duplicates",
    """SELECT l_orderkey, l_linenumber, row_number() OVER
        (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) - 1 AS repeat
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) > 1""",
)
def check_duplicates(t):
    return v.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "check_required",
    f"WITH {PROCESSORS_SQL} SELECT * FROM processors WHERE type = ''",
)
def check_required(t):
    return v.blank_required(roles.processors(t), ["type"])


def _line_names(t):
    return t.lineitem.select(
        text("l_orderkey").alias("pipeline_id"), text("l_linenumber").alias("name")
    )


@query(
    "check_dangling_source",
    f"""WITH {NAMES_SQL}
    SELECT CAST(l_orderkey AS VARCHAR) AS pipeline_id,
           CAST(l_linenumber + 1 AS VARCHAR) AS source, CAST(l_linenumber AS VARCHAR) AS destination
    FROM lineitem l WHERE NOT EXISTS (
      SELECT 1 FROM names n WHERE n.pipeline_id = CAST(l.l_orderkey AS VARCHAR)
        AND n.name = CAST(l.l_linenumber + 1 AS VARCHAR))""",
)
def check_dangling_source(t):
    edges = roles.edges(t, step=-1).select("pipeline_id", "source", "destination")
    return v.dangling_refs(
        edges, _line_names(t), [("pipeline_id", "pipeline_id"), ("source", "name")]
    )


@query(
    "check_dangling_destination",
    f"""WITH {NAMES_SQL}
    SELECT CAST(l_orderkey AS VARCHAR) AS pipeline_id,
           CAST(l_linenumber AS VARCHAR) AS source, CAST(l_linenumber + 1 AS VARCHAR) AS destination
    FROM lineitem l WHERE NOT EXISTS (
      SELECT 1 FROM names n WHERE n.pipeline_id = CAST(l.l_orderkey AS VARCHAR)
        AND n.name = CAST(l.l_linenumber + 1 AS VARCHAR))""",
)
def check_dangling_destination(t):
    edges = roles.edges(t).select("pipeline_id", "source", "destination")
    return v.dangling_refs(
        edges, _line_names(t), [("pipeline_id", "pipeline_id"), ("destination", "name")]
    )


@query(
    "check_empty_list",
    f"WITH {EDGES_SQL} SELECT pipeline_id, source, destination FROM edges WHERE unrelated",
)
def check_empty_list(t):
    return v.empty_list(roles.edges(t), "relationships").select(
        "pipeline_id", "source", "destination"
    )


def _definitions(t):
    """The tables of the corpus, without its JSON form."""
    spark = t.spark
    none = lambda schema: spark.createDataFrame([], schema)
    ports = t.nation.select(
        F.col("n_name").alias("pipeline_id"),
        F.col("n_nationkey").alias("pos"),
        F.col("n_name").alias("name"),
        F.lit("INPUT").alias("port_type"),
    )
    return d.Definitions(
        pipelines=roles.pipelines(t),
        processors=roles.processors(t),
        connections=roles.edges(t),
        services=roles.services(t),
        contexts=roles.contexts(t),
        parameters=t.part.select(
            F.col("p_brand").alias("pipeline_id"),
            F.col("p_partkey").cast("int").alias("context_pos"),
            F.col("p_name").alias("context"),
            F.col("p_type").alias("name"),
            F.col("p_name").alias("value"),
            (F.col("p_size") % 2 == 0).alias("sensitive"),
            F.lit("").alias("description"),
        ),
        ports=ports,
        rejects=none("pipeline_id string, reason string"),
    )


ISSUES_SQL = f"""{PROCESSORS_SQL}, {EDGES_SQL}, {NAMES_SQL},
  services AS (SELECT CAST(o_custkey AS VARCHAR) AS pipeline_id, o_orderpriority AS name
               FROM orders),
  contexts AS (SELECT p_brand AS pipeline_id, p_name AS name FROM part),
  ends AS (
    SELECT pipeline_id, 'dangling_source' AS rule, source AS name FROM edges
    UNION ALL SELECT pipeline_id, 'dangling_destination', destination FROM edges),
  repeats AS (
    SELECT pipeline_id, 'duplicate_processor' AS rule, name,
           row_number() OVER (PARTITION BY pipeline_id, name) AS n FROM processors
    UNION ALL SELECT pipeline_id, 'duplicate_service', name,
           row_number() OVER (PARTITION BY pipeline_id, name) FROM services
    UNION ALL SELECT pipeline_id, 'duplicate_context', name,
           row_number() OVER (PARTITION BY pipeline_id, name) FROM contexts),
  issues AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, 'empty' AS rule,
           CAST(NULL AS VARCHAR) AS subject,
           'Pipeline must contain at least one processor.' AS message
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT pipeline_id, rule, name,
           CASE rule WHEN 'duplicate_processor' THEN 'Duplicate processor name: '''
             WHEN 'duplicate_service' THEN 'Duplicate controller service name: '''
             ELSE 'Duplicate parameter context name: ''' END || name || '''.'
    FROM repeats WHERE n > 1
    UNION ALL
    SELECT pipeline_id, 'missing_type', name, 'Processor ''' || name || ''' is missing a type.'
    FROM processors WHERE type = ''
    UNION ALL
    SELECT pipeline_id, rule, name,
           CASE rule WHEN 'dangling_source' THEN 'Connection source ''' ELSE
             'Connection destination ''' END || name || ''' does not match any processor name.'
    FROM ends e WHERE NOT EXISTS (
      SELECT 1 FROM names n WHERE n.pipeline_id = e.pipeline_id AND n.name = e.name)
    UNION ALL
    SELECT pipeline_id, 'no_relationships', source || ' → ' || destination,
           'Connection ''' || source || ''' → ''' || destination || ''' has no relationships.'
    FROM edges WHERE unrelated)"""


@query("validate_all", f"WITH {ISSUES_SQL} SELECT * FROM issues")
def validate_all(t):
    return v.validate(_definitions(t))


def _checked(t):
    """Definitions of which a part breaks no rule: every third order's edges lead back to their line."""
    edges = roles.edges(t).withColumn(
        "destination", F.when(F.col("pipeline_id").cast("bigint") % 3 == 0, F.col("source")).otherwise(F.col("destination"))
    )
    contexts = t.part.select(
        text("p_partkey").alias("pipeline_id"), F.col("p_size").alias("pos"), F.col("p_name").alias("name"), F.lit("").alias("description")
    )
    parameters = t.part.select(
        text("p_partkey").alias("pipeline_id"),
        F.col("p_size").alias("context_pos"),
        F.col("p_name").alias("context"),
        F.explode(F.array(F.struct(F.lit(0).alias("pos"), F.lit("type").alias("name"), F.col("p_type").alias("value")),
                          F.struct(F.lit(1).alias("pos"), F.lit("brand").alias("name"), F.col("p_brand").alias("value")))).alias("p"),
        (F.col("p_size") % 2 == 0).alias("sensitive"),
        F.lit("").alias("description"),
    ).select("pipeline_id", "context_pos", "context", "p.name", "p.value", "sensitive", "description", "p.pos")
    ports = t.supplier.select(
        text("s_suppkey").alias("pipeline_id"), F.col("s_nationkey").alias("pos"), F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 2 == 0, "INPUT").otherwise("OUTPUT").alias("port_type"),
    )
    processors = roles.processors(t).withColumns(
        {
            "properties": F.create_map(F.lit("line"), "name"),
            "scheduling": F.create_map().cast("map<string,string>"),
            "auto_terminated": F.array(F.lit("failure")),
        }
    )
    rejects = t.spark.createDataFrame([], "pipeline_id string, reason string")
    return d.Definitions(roles.pipelines(t), processors, edges, roles.services(t), contexts, parameters, ports, rejects)


CHECKED_SQL = f"""{PROCESSORS_SQL},
  edges AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS pipeline_id, l_linenumber AS pos, CAST(l_linenumber AS VARCHAR) AS source,
           CAST(CASE WHEN l_orderkey % 3 = 0 THEN l_linenumber ELSE l_linenumber + 1 END AS VARCHAR) AS destination,
           l_returnflag = 'R' AS unrelated, l_linenumber FROM lineitem),
  {NAMES_SQL},
  services AS (SELECT CAST(o_custkey AS VARCHAR) AS pipeline_id, o_orderkey AS pos, o_orderpriority AS name, o_orderstatus AS status FROM orders),
  contexts AS (SELECT CAST(p_partkey AS VARCHAR) AS pipeline_id, p_size AS pos, p_name AS name, p_type, p_brand FROM part),
  ports AS (SELECT CAST(s_suppkey AS VARCHAR) AS pipeline_id, s_nationkey AS pos, s_name AS name FROM supplier),
  flows AS (SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, 'flow-' || o_orderkey AS name FROM orders)"""


@query(
    "definition_summary",
    f"""WITH {CHECKED_SQL},
    broken AS (
      SELECT pipeline_id FROM processors GROUP BY pipeline_id, name HAVING count(*) > 1
      UNION ALL SELECT pipeline_id FROM services GROUP BY pipeline_id, name HAVING count(*) > 1
      UNION ALL SELECT pipeline_id FROM contexts GROUP BY pipeline_id, name HAVING count(*) > 1
      UNION ALL SELECT pipeline_id FROM processors WHERE type = ''
      UNION ALL SELECT pipeline_id FROM edges WHERE unrelated
      UNION ALL SELECT e.pipeline_id FROM edges e WHERE NOT EXISTS (
        SELECT 1 FROM names n WHERE n.pipeline_id = e.pipeline_id AND n.name = e.destination))
    SELECT f.pipeline_id, f.name,
           (SELECT count(*) FROM processors x WHERE x.pipeline_id = f.pipeline_id) AS processors,
           (SELECT count(*) FROM edges x WHERE x.pipeline_id = f.pipeline_id) AS connections,
           (SELECT count(*) FROM services x WHERE x.pipeline_id = f.pipeline_id) AS services,
           (SELECT count(*) FROM contexts x WHERE x.pipeline_id = f.pipeline_id) AS contexts,
           (SELECT count(*) FROM ports x WHERE x.pipeline_id = f.pipeline_id) AS ports
    FROM flows f WHERE f.pipeline_id IN (SELECT pipeline_id FROM processors) AND f.pipeline_id NOT IN (SELECT pipeline_id FROM broken)""",
)
def definition_summary(t):
    return v.summarise(_checked(t))


def _component(*fields):
    """SQL for a component of a manifest from SQL of its fields."""
    return """'{"revision":{"version":0},"component":{' || """ + " || ".join(fields) + """ || '}}'"""


@query(
    "nest_manifest",
    f"""WITH {CHECKED_SQL}, kinds AS (
      SELECT pipeline_id, 'head' AS kind, 0 AS pos, '{{"processGroup":' || {_component("""'"name":"'""", "name", """'"'""")} AS body FROM flows
      UNION ALL
      SELECT pipeline_id, 'processors', pos, {_component("""'"type":"'""", "type", """'","name":"'""", "name",
        """'","config":{"properties":{"line":"'""", "name", """'"},"autoTerminatedRelationships":["failure"]}'""")} FROM processors
      UNION ALL
      SELECT pipeline_id, 'connections', pos, {_component("""'"source":{"id":"","type":"PROCESSOR"},"destination":{"id":"","type":"PROCESSOR"},"selectedRelationships":['""",
        """CASE WHEN unrelated THEN '' ELSE '"success"' END""", "']'",
        """CASE WHEN l_linenumber > 2 THEN ',"backPressureObjectThreshold":' || (l_linenumber * 100) ELSE '' END""",
        """CASE WHEN l_linenumber = 4 THEN ',"backPressureDataSizeThreshold":"1 GB"' ELSE '' END""")} FROM edges
      UNION ALL
      SELECT pipeline_id, 'services', pos, {_component("""'"type":"org.example.'""", "status", """'","name":"'""", "name",
        """'","properties":{"status":"'""", "status", """'"}'""")} FROM services
      UNION ALL
      SELECT pipeline_id, 'contexts', pos, {_component("""'"name":"'""", "name", """'","parameters":[{"parameter":{"name":"type","value":"'""", "p_type",
        """'","sensitive":'""", "(pos % 2 = 0)", """'}},{"parameter":{"name":"brand","value":"'""", "p_brand", """'","sensitive":'""", "(pos % 2 = 0)", "'}}]'")} FROM contexts
      UNION ALL
      SELECT pipeline_id, 'ports', pos, {_component("""'"name":"'""", "name", """'","type":"'""",
        """CASE WHEN pos % 2 = 0 THEN 'INPUT' ELSE 'OUTPUT' END""", """'_PORT"'""")} FROM ports),
    lists AS (SELECT pipeline_id, max(CASE WHEN kind = 'head' THEN body END) AS head,
                string_agg(body, ',' ORDER BY pos, body) FILTER (kind = 'processors') AS p,
                string_agg(body, ',' ORDER BY pos, body) FILTER (kind = 'connections') AS c,
                string_agg(body, ',' ORDER BY pos, body) FILTER (kind = 'services') AS s,
                string_agg(body, ',' ORDER BY pos, body) FILTER (kind = 'contexts') AS x,
                string_agg(body, ',' ORDER BY pos, body) FILTER (kind = 'ports') AS o
              FROM kinds GROUP BY pipeline_id HAVING count(*) FILTER (kind = 'head') > 0)
    SELECT pipeline_id, CAST(0 AS BIGINT) AS part,
           head || ',"parameterContexts":[' || coalesce(x, '') || '],"controllerServices":[' || coalesce(s, '') || '],"processors":['
           || coalesce(p, '') || '],"connections":[' || coalesce(c, '') || '],"ports":[' || coalesce(o, '') || ']}}' AS document
    FROM lists""",
)
def nest_manifest(t):
    """All child tables; children of a parent that is not there are left out."""
    found = d.manifest(_checked(t))
    return found.join(roles.pipelines(t).select("pipeline_id"), "pipeline_id", "left_semi")


@query(
    "round_trip_contexts",
    """SELECT n_nationkey::VARCHAR AS pipeline_id, c_mktsegment AS context, c_name AS name, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS value,
              CAST(row_number() OVER (PARTITION BY n_nationkey, c_mktsegment ORDER BY c_custkey) - 1 AS INTEGER) AS pos
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def round_trip_contexts(t):
    """Contexts of dozens of parameters, cut into slices of five, are whole again when parsed."""
    customers = t.customer.select(
        text("c_nationkey").alias("pipeline_id"),
        F.ascii("c_mktsegment").alias("context_pos"),
        F.col("c_mktsegment").alias("context"),
        F.col("c_name").alias("name"),
        text(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("value"),
        F.lit(False).alias("sensitive"),
        F.lit("").alias("description"),
        F.col("c_custkey").cast("int").alias("pos"),
    )
    contexts = customers.select("pipeline_id", F.col("context_pos").alias("pos"), F.col("context").alias("name"), F.lit("").alias("description")).distinct()
    nations = t.nation.select(text("n_nationkey").alias("pipeline_id"), F.col("n_name").alias("name"))
    none = _checked(t)
    only = d.Definitions(nations, *[df.where("false") for df in (none.processors, none.connections, none.services)], contexts, customers, none.ports.where("false"), none.rejects)
    again = d.parse_definitions(d.definition_documents(only, part_rows=5), "pipeline_id", "document", "part")
    repeats = v.validate(again).where("rule = 'duplicate_context'").select("pipeline_id")
    return again.parameters.join(repeats, "pipeline_id", "left_anti").select("pipeline_id", "context", "name", "value", "pos")
