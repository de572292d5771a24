"""Parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import params as p
from workload import roles
from workload.registry import query, text


@query(
    "override_properties",
    """SELECT p_partkey, p_brand AS brand,
           CASE WHEN p_size > 25 THEN 'type-' || p_size ELSE p_type END AS type,
           CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS size
    FROM part""",
)
def override_properties(t):
    parts = t.part.select(
        "p_partkey",
        F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")).alias(
            "properties"
        ),
    )
    overrides = t.part.where("p_size > 25").select(
        "p_partkey",
        F.create_map(
            F.lit("type"), F.concat(F.lit("type-"), "p_size"), F.lit("size"), text("p_size")
        ).alias("properties"),
    )
    entry = lambda k: F.try_element_at("properties", F.lit(k)).alias(k)
    return p.override_properties(parts, overrides, "p_partkey").select(
        "p_partkey", entry("brand"), entry("type"), entry("size")
    )


SUBSTITUTE_SQL = """SELECT doc_id,
    lang || ': ' || CASE WHEN coalesce(length(source), 0) % 2 = 0 THEN '<#{lang}/' || source || '>'
      ELSE '#{' || source || '}' END || ' in ' || lang || '-name' AS template,
    CASE WHEN length(source) % 2 = 0 THEN '' ELSE source END AS unresolved
    FROM documents"""


def _templates(t):
    """Texts with two references; the value of one looks like a reference itself."""
    templates = t.documents.select(
        "doc_id",
        F.col("lang").alias("context"),
        F.concat("lang", F.lit(": #{"), "source", F.lit("} in #{lang}")).alias("template"),
    )
    sources = t.documents.select(
        F.col("lang").alias("context"),
        F.col("source").alias("name"),
        F.concat(F.lit("<#{lang}/"), "source", F.lit(">")).alias("value"),
    ).where(F.length("name") % 2 == 0)
    langs = t.documents.select(
        F.col("lang").alias("context"),
        F.lit("lang").alias("name"),
        F.concat("lang", F.lit("-name")).alias("value"),
    )
    return templates, sources.unionByName(langs).distinct()


def _substituted(df):
    return df.select("doc_id", "template", F.array_join("unresolved", ",").alias("unresolved"))


@query("substitute_params", SUBSTITUTE_SQL)
def substitute_params(t):
    templates, values = _templates(t)
    return _substituted(p.substitute(templates, "template", values, "context"))


@query("substitute_params_joined", SUBSTITUTE_SQL)
def substitute_params_joined(t):
    """The same with each parameter given twice, the second time with a larger value."""
    templates, values = _templates(t)
    again = values.withColumn("value", F.concat("value", F.lit("~")))
    return _substituted(p.substitute(templates, "template", values.union(again), "context"))


@query(
    "mask_sensitive",
    f"""WITH {roles.PARAMETERS_SQL}
    SELECT context, name, CASE WHEN NOT sensitive THEN value END AS value, sensitive
    FROM params""",
)
def mask_sensitive(t):
    return p.mask_sensitive(roles.parameters(t))


@query(
    "bind_context",
    """SELECT b.pipeline_id, arg_min(p_name, p_partkey) AS context
    FROM (SELECT DISTINCT p_brand AS pipeline_id FROM part
          UNION ALL SELECT r_name FROM region) b
    LEFT JOIN part ON p_brand = b.pipeline_id GROUP BY b.pipeline_id""",
)
def bind_context(t):
    owners = t.part.select(F.col("p_brand").alias("pipeline_id")).distinct()
    bare = t.region.select(F.col("r_name").alias("pipeline_id"))
    return p.bind_context(owners.unionByName(bare), roles.contexts(t))


@query(
    "apply_params",
    f"""WITH {roles.PARAMETERS_SQL},
    sets AS (SELECT p_brand AS context, p_name AS name, arg_max(p_type, p_partkey) AS value,
                    arg_max(p_size, p_partkey) % 2 = 0 AS sensitive
             FROM part WHERE p_size > 25 GROUP BY p_brand, p_name),
    changed AS (SELECT * FROM sets
      UNION ALL SELECT * FROM params p WHERE NOT EXISTS (
        SELECT 1 FROM sets s WHERE s.context = p.context AND s.name = p.name))
    SELECT * FROM changed c WHERE NOT EXISTS (
      SELECT 1 FROM part WHERE p_size < 3 AND p_brand = c.context
        AND c.name IN (p_name, p_type))""",
)
def apply_params(t):
    sets = t.part.where("p_size > 25").select(
        F.col("p_brand").alias("context"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("value"),
        (F.col("p_size") % 2 == 0).alias("sensitive"),
        F.col("p_partkey").alias("seq"),
    )
    removals = t.part.where("p_size < 3").select(
        F.col("p_brand").alias("context"), F.explode(F.array("p_name", "p_type")).alias("name")
    )
    return p.apply_params(roles.parameters(t), sets, removals)


@query(
    "apply_params_json",
    f"""WITH {roles.PARAMETERS_SQL},
    sets AS (SELECT p_brand AS context, p_name AS name, arg_max(p_type, p_partkey) AS value,
                    arg_max(p_size, p_partkey) % 2 = 0 AS sensitive
             FROM part WHERE p_size > 25 GROUP BY p_brand, p_name),
    changed AS (SELECT * FROM sets
      UNION ALL SELECT * FROM params p WHERE NOT EXISTS (
        SELECT 1 FROM sets s WHERE s.context = p.context AND s.name = p.name))
    SELECT *, CAST(NULL AS VARCHAR) AS reason FROM changed c WHERE NOT EXISTS (
      SELECT 1 FROM part WHERE p_size < 3 AND p_brand = c.context
        AND c.name IN (p_name, p_type))
    UNION ALL SELECT p_brand, NULL, NULL, NULL, 'parameters must be a JSON object.' FROM part
      WHERE p_size = 25""",
)
def apply_params_json(t):
    """The sets of ``apply_params`` as JSON text, some of it broken."""
    entry = F.struct(F.col("p_type").alias("value"), (F.col("p_size") % 2 == 0).alias("sensitive"))
    texts = t.part.where("p_size >= 25").select(
        F.col("p_brand").alias("context"),
        F.when(F.col("p_size") == 25, "[1]").otherwise(F.to_json(F.create_map("p_name", entry))).alias("text"),
        F.col("p_partkey").alias("seq"),
    )
    sets, rejects = p.parse_parameter_entries(texts, "context", "text")
    removals = t.part.where("p_size < 3").select(
        F.col("p_brand").alias("context"), F.explode(F.array("p_name", "p_type")).alias("name")
    )
    changed = p.apply_params(roles.parameters(t), sets, removals)
    return changed.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.select("context", "reason"), allowMissingColumns=True
    )


@query(
    "inherited_params",
    """WITH levels AS (
      SELECT 'c' || c_custkey AS context, 'c' || c_custkey AS origin, 0 AS depth FROM customer
      UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 1 FROM customer
      UNION ALL SELECT 'c' || c_custkey, 'r' || n_regionkey, 2 FROM customer
        JOIN nation ON n_nationkey = c_nationkey
      UNION ALL SELECT 'n' || n_nationkey, 'n' || n_nationkey, 0 FROM nation
      UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 1 FROM nation
      UNION ALL SELECT 'r' || r_regionkey, 'r' || r_regionkey, 0 FROM region),
    params AS (
      SELECT 'c' || c_custkey AS origin, 'level' AS name, 'customer' AS value,
             c_custkey % 2 = 0 AS sensitive FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT 'c' || c_custkey, 'segment', c_mktsegment, false FROM customer
      UNION ALL SELECT 'n' || n_nationkey, 'level', 'nation', false FROM nation
        WHERE n_regionkey > 1
      UNION ALL SELECT 'r' || r_regionkey, 'level', 'region', false FROM region
      UNION ALL SELECT 'r' || r_regionkey, 'region', r_name, true FROM region)
    SELECT context, name, arg_min(value, depth) AS value, arg_min(sensitive, depth) AS sensitive,
           arg_min(origin, depth) AS origin, CAST(min(depth) AS INTEGER) AS depth
    FROM levels JOIN params USING (origin) GROUP BY context, name""",
)
def inherited_params(t):
    def entries(df, prefix, key, name, value, sensitive):
        return df.select(
            F.concat(F.lit(prefix), key).alias("context"),
            F.lit(name).alias("name"),
            value.alias("value"),
            sensitive.alias("sensitive"),
        )

    no = F.lit(False)
    parts = [
        entries(
            t.customer.where("c_acctbal < 0"), "c", "c_custkey", "level", F.lit("customer"),
            F.col("c_custkey") % 2 == 0,
        ),
        entries(t.customer, "c", "c_custkey", "segment", F.col("c_mktsegment"), no),
        entries(
            t.nation.where("n_regionkey > 1"), "n", "n_nationkey", "level", F.lit("nation"), no
        ),
        entries(t.region, "r", "r_regionkey", "level", F.lit("region"), no),
        entries(t.region, "r", "r_regionkey", "region", F.col("r_name"), F.lit(True)),
    ]
    params = parts[0]
    for part in parts[1:]:
        params = params.unionByName(part)
    inherits = roles.groups(t).where("parent_id IS NOT NULL").select(
        F.col("group_id").alias("child"), F.col("parent_id").alias("parent"), F.lit(0).alias("rank")
    )
    return p.inherited_params(params, inherits)
