"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .functions import calc, dates, tables, text, units
from .operators import kg, quality, sampling, similarity, stats
from .plans import escalation, providers, quality_control, tools, tracks
from .scratch import Scratch, ship
from .sources import files
from .streaming import events

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    ship(spark)
    return files.table(spark, d, name)


def values(spark: SparkSession, rows: str, names: str) -> DataFrame:
    ship(spark)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v({names})")


# ---- the graph of the dimension tables -----------------------------------------

ENT = """ent AS (
  SELECT 'region:' || r_regionkey AS id, r_name AS name, 'region' AS entity_type, r_name AS value, r_regionkey::BIGINT AS seq FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, n_name, 'nation', n_name, 1000 + n_nationkey FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, c_name, 'customer', c_mktsegment, 1000000000 + c_custkey FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, s_name, 'supplier', s_name, 2000000000 + s_suppkey FROM supplier
  UNION ALL SELECT 'part:' || p_partkey, p_name, 'part', p_type, 3000000000 + p_partkey FROM part)"""
GEO = """rel AS (
  SELECT 'nation:' || n_nationkey AS s, 'region:' || n_regionkey AS t, 'in_region' AS k FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey, 'located_in' FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey, 'located_in' FROM supplier)"""
REL = GEO[:-1] + """
  UNION ALL SELECT DISTINCT 'part:' || l_partkey, 'supplier:' || l_suppkey, 'supplied_by' FROM lineitem)"""
BOTH = "und AS (SELECT s AS a, t AS b FROM rel UNION ALL SELECT t, s FROM rel)"


def entities(spark, d) -> DataFrame:
    def one(name, key, label, value, base):
        return t(spark, d, name).select(
            F.concat(F.lit(f"{name}:"), F.col(key)).alias("id"), F.col(label).alias("name"), F.lit(name).alias("entity_type"), F.col(value).alias("value"), (F.col(key) + F.lit(base).cast("long")).cast("long").alias("seq")
        )

    return sampling.union_all([one("region", "r_regionkey", "r_name", "r_name", 0), one("nation", "n_nationkey", "n_name", "n_name", 1000), one("customer", "c_custkey", "c_name", "c_mktsegment", 10**9), one("supplier", "s_suppkey", "s_name", "s_name", 2 * 10**9), one("part", "p_partkey", "p_name", "p_type", 3 * 10**9)])


def relations(spark, d) -> DataFrame:
    def one(df, name, key, to, to_key, kind, seq):
        return df.select(F.concat(F.lit(f"{name}:"), F.col(key)).alias("source_id"), F.concat(F.lit(f"{to}:"), F.col(to_key)).alias("target_id"), F.lit(kind).alias("relation_type"), seq.cast("long").alias("edge_seq"))

    made = [one(t(spark, d, name), name, key, to, to_key, kind, F.col(key) + F.lit(base).cast("long")) for name, key, to, to_key, kind, base in (("nation", "n_nationkey", "region", "n_regionkey", "in_region", 0), ("customer", "c_custkey", "nation", "c_nationkey", "located_in", 10**9), ("supplier", "s_suppkey", "nation", "s_nationkey", "located_in", 2 * 10**9))]
    pairs = kg.dealt(t(spark, d, "lineitem").select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey").distinct()
    made.append(one(pairs, "part", "l_partkey", "supplier", "l_suppkey", "supplied_by", F.lit(10**13).cast("long") + F.col("l_partkey") * 10**7 + F.col("l_suppkey")))
    return sampling.union_all(made).withColumn("evidence", F.lit("foreign key"))


@query(f"WITH {ENT} SELECT id, name, entity_type, value, seq::BIGINT AS seq FROM ent")
def kg_entities(spark, d):
    e = entities(spark, d)
    return kg.last_wins(e.unionByName(e.filter("entity_type = 'region'").withColumn("seq", F.col("seq"))), ["id"], "seq").select("id", "name", "entity_type", "value", "seq")


@query(f"WITH {REL} SELECT s AS source_id, t AS target_id, k AS relation_type FROM rel")
def kg_relations(spark, d):
    return relations(spark, d).drop("evidence", "edge_seq")


@query(f"WITH {ENT}, {REL} SELECT (SELECT count(*) FROM ent)::BIGINT AS n_entities, (SELECT count(*) FROM rel)::BIGINT AS n_relations, (SELECT count(DISTINCT (s, t)) FROM rel)::BIGINT AS n_edges")
def kg_counts(spark, d):
    return kg.counts(entities(spark, d), relations(spark, d))


@query(f"WITH {REL}, {BOTH} SELECT a AS node, count(*)::BIGINT AS degree FROM und GROUP BY a")
def kg_degree(spark, d):
    return kg.degree(kg.edges(relations(spark, d)))


@query(f"""WITH {REL}, {BOTH}, one AS (SELECT DISTINCT a AS start, b AS node FROM und WHERE a IN ('region:1', 'nation:3')),
two AS (SELECT DISTINCT o.start, u.b AS node FROM one o JOIN und u ON u.a = o.node WHERE u.b <> o.start)
SELECT start, node, CASE WHEN (start, node) IN (SELECT (start, node) FROM one) THEN 1 ELSE 2 END AS hop FROM (SELECT * FROM one UNION SELECT * FROM two)""")
def kg_neighbours_2hop(spark, d):
    start = values(spark, "('region:1'), ('nation:3')", "node")
    return kg.neighbours(kg.edges(relations(spark, d)), start, 2)


@query(f"""WITH {REL}, ids AS (SELECT 'supplier:' || s_suppkey AS id FROM supplier WHERE s_nationkey < 5 UNION ALL SELECT 'nation:' || n_nationkey FROM nation WHERE n_nationkey < 8)
SELECT s AS source_id, t AS target_id, k AS relation_type FROM rel WHERE s IN (SELECT id FROM ids) AND t IN (SELECT id FROM ids)""")
def kg_induced_subgraph(spark, d):
    s = t(spark, d, "supplier").filter("s_nationkey < 5").select(F.concat(F.lit("supplier:"), "s_suppkey").alias("id"))
    n = t(spark, d, "nation").filter("n_nationkey < 8").select(F.concat(F.lit("nation:"), "n_nationkey").alias("id"))
    return kg.induced(relations(spark, d), s.union(n)).select("source_id", "target_id", "relation_type")


@query(f"""WITH RECURSIVE {REL}, {BOTH}, lab(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM und
  UNION (SELECT u.a, min(l.component) FROM lab l JOIN und u ON u.b = l.node JOIN recurring.lab now ON now.node = u.a WHERE l.component < now.component GROUP BY u.a)) SELECT node, component FROM lab""")
def kg_components(spark, d):
    e = Scratch(spark, "edges").keep(kg.edges(relations(spark, d)))
    return kg.components(e.select(F.col("src").alias("node")).union(e.select("dst")), e)


PAIRS = "p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)"
#: The graph of similar embeddings: many components, some of one node.
NEAR = f"{PAIRS}, und AS (SELECT a, b FROM p WHERE sim >= 0.3 UNION ALL SELECT b, a FROM p WHERE sim >= 0.3), reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, u.b FROM reach r JOIN und u ON u.a = r.b), comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"


def _near(spark, d):
    """The similar embeddings, dealt, and their components."""
    dealt = _dealt(spark, d)
    e = Scratch(spark, "near").keep(similarity.linking_pairs(dealt, 0.3))
    return dealt, kg.components(t(spark, d, "embeddings").select(F.col("vec_id").alias("node")), e)


@query(f"WITH RECURSIVE {NEAR} SELECT component, count(*)::BIGINT AS size, row_number() OVER (ORDER BY count(*) DESC, component) AS place FROM comp GROUP BY component")
def kg_component_sizes(spark, d):
    return kg.ordered_components(_near(spark, d)[1])


@query(f"""WITH RECURSIVE {NEAR}, sizes AS (SELECT component, count(*) AS n FROM comp GROUP BY component)
SELECT a.component AS first, b.component AS second FROM sizes a JOIN sizes b ON (a.n, b.component) > (b.n, a.component)""")
def component_pairs(spark, d):
    return kg.all_pairs(Scratch(spark, "pairs").keep(kg.ordered_components(_near(spark, d)[1])), "component", "place")


@query(f"""WITH RECURSIVE {NEAR}, deg AS (SELECT component, node, (SELECT count(*) FROM und WHERE und.a = node) AS degree FROM comp),
ranked AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY degree DESC, node) AS place FROM deg),
tail AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY md5('reps|' || node), node) AS pick FROM ranked WHERE place > 5)
SELECT component, node, 'top' AS kind FROM ranked WHERE place <= 5 UNION ALL SELECT component, node, 'tail' FROM tail WHERE pick = 1""")
def component_reps(spark, d):
    dealt, labels = _near(spark, d)
    degrees = similarity.neighbour_counts(dealt, 0.3).toDF("node", "degree")
    return kg.representatives(labels, degrees, 5, "reps")


@query(f"""WITH RECURSIVE {ENT}, {GEO}, {BOTH}, node AS (SELECT id AS n FROM ent WHERE entity_type <> 'part'),
lab(node, component) USING KEY (node) AS (SELECT n, n FROM node
  UNION (SELECT u.a, min(l.component) FROM lab l JOIN und u ON u.b = l.node JOIN recurring.lab now ON now.node = u.a WHERE l.component < now.component GROUP BY u.a)),
sizes AS (SELECT component, count(*) AS n FROM lab GROUP BY component),
deg AS (SELECT component, node, (SELECT count(*) FROM und WHERE und.a = node) AS degree FROM lab),
ranked AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY degree DESC, node) AS place FROM deg),
tail AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY md5('reps|' || node), node) AS pick FROM ranked WHERE place > 5),
rep AS (SELECT component, node FROM ranked WHERE place <= 5 UNION ALL SELECT component, node FROM tail WHERE pick = 1),
said AS (SELECT DISTINCT component, node, unnest(list_filter(regexp_split_to_array(lower(name || ' ' || value), '[^a-z0-9]+'), lambda x: length(x) > 2)) AS term FROM rep JOIN ent ON id = node),
met AS (SELECT x.component AS f, y.component AS g, x.node AS s, y.node AS t, count(*) AS n, string_agg(x.term, ', ' ORDER BY x.term) AS terms
  FROM said x JOIN said y USING (term) JOIN sizes a ON a.component = x.component JOIN sizes b ON b.component = y.component WHERE (a.n, b.component) > (b.n, a.component) GROUP BY ALL)
SELECT s AS source_id, t AS target_id, 'same_topic' AS relation_type, 'Shared terms: ' || terms AS evidence FROM met QUALIFY row_number() OVER (PARTITION BY f, g ORDER BY n DESC, s, t) <= 4""")
def kg_stitch(spark, d):
    """The graph of the regions, nations, customers and suppliers falls into a part
    for each region."""
    whole = entities(spark, d).filter("entity_type <> 'part'")
    return kg.stitch(whole, relations(spark, d).filter("relation_type <> 'supplied_by'"))


@query(f"""WITH RECURSIVE {REL}, {BOTH}, bfs(node, hops) AS (SELECT 'customer:1', 0 UNION SELECT u.b, hops + 1 FROM bfs JOIN und u ON u.a = node WHERE hops < 8)
SELECT 'customer:1' AS start, node, min(hops) AS hops FROM bfs GROUP BY node""")
def kg_shortest_lengths(spark, d):
    return kg.distances(kg.edges(relations(spark, d)), values(spark, "('customer:1')", "node")).select("start", "node", "hops")


@query(f"""WITH RECURSIVE {REL}, {BOTH}, bfs(node, hops) AS (SELECT 'customer:1', 0 UNION SELECT u.b, hops + 1 FROM bfs JOIN und u ON u.a = node WHERE hops < 8)
SELECT max(h)::INT AS diameter_from_start FROM (SELECT min(hops) AS h FROM bfs GROUP BY node)""")
def kg_eccentricity(spark, d):
    return kg_shortest_lengths(spark, d).agg(F.max("hops").alias("diameter_from_start"))


@query(f"""WITH RECURSIVE {REL}, {BOTH},
bfs(node, hops) AS (SELECT 'customer:1', 0 UNION SELECT u.b, hops + 1 FROM bfs JOIN und u ON u.a = node WHERE hops < 8),
dist AS (SELECT node, min(hops) AS hops FROM bfs GROUP BY node),
parent AS (SELECT d.node, d.hops, min(p.node) AS parent FROM dist d JOIN und u ON u.a = d.node JOIN dist p ON p.node = u.b AND p.hops = d.hops - 1 GROUP BY d.node, d.hops),
back(target, node) AS (SELECT node, node FROM dist WHERE node LIKE 'supplier:%' UNION SELECT b.target, p.parent FROM back b JOIN parent p ON p.node = b.node)
SELECT target, node FROM back""")
def kg_connectors(spark, d):
    found = kg.distances(kg.edges(relations(spark, d)), values(spark, "('customer:1')", "node"))
    goals = found.filter("node like 'supplier:%'").select("start", F.col("node").alias("target"))
    return kg.paths(found, goals).select("target", "node").distinct()


WALK = f"""{REL}, {BOTH}, around AS (SELECT a AS node, list_sort(list(b)) AS nb FROM und GROUP BY a),
walk(walk, step, node) AS (SELECT 'customer:' || c_custkey, 0, 'customer:' || c_custkey FROM customer
  UNION ALL SELECT w.walk, w.step + 1, nb[1 + (('0x' || substr(md5('walk|' || w.walk || '|' || (w.step + 1)), 1, 8))::BIGINT % len(nb))] FROM walk w JOIN around USING (node) WHERE w.step < 10)"""


def _walk_starts(spark, d):
    return t(spark, d, "customer").select(F.concat(F.lit("customer:"), "c_custkey").alias("walk"), F.concat(F.lit("customer:"), "c_custkey").alias("node"))


@query(f"WITH RECURSIVE {WALK} SELECT walk, step, node FROM walk")
def kg_random_walk(spark, d):
    return kg.random_walk(Scratch(spark, "edges").keep(kg.edges(relations(spark, d))), _walk_starts(spark, d), 10, "walk")


@query(f"""WITH RECURSIVE {WALK}, first AS (SELECT walk, node, min(step) AS step FROM walk GROUP BY walk, node),
seen AS (SELECT walk, row_number() OVER (PARTITION BY walk ORDER BY step) AS pos, node FROM first QUALIFY pos <= 8),
size AS (SELECT walk, max(pos) AS size FROM seen GROUP BY walk),
spare AS (SELECT node FROM (SELECT DISTINCT a AS node FROM und) ORDER BY md5('walk|' || node), node LIMIT 12),
fill AS (SELECT z.walk, size + row_number() OVER (PARTITION BY z.walk ORDER BY md5('walk|' || p.node), p.node) AS pos, p.node
  FROM size z, spare p WHERE size < 6 AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.walk = z.walk AND s.node = p.node) QUALIFY pos <= 6)
SELECT walk, pos::INT AS pos, node FROM seen UNION ALL SELECT walk, pos::INT, node FROM fill""")
def walk_sample(spark, d):
    e = Scratch(spark, "edges").keep(kg.edges(relations(spark, d)))
    return kg.walk_sample(e, kg.degree(e), _walk_starts(spark, d), 6, 8, 10, "walk")


@query(f"""WITH {REL}, {BOTH}, turns AS (SELECT node, row_number() OVER (ORDER BY md5('bridge|' || node), node) - 1 AS turn FROM (SELECT DISTINCT a AS node FROM und) QUALIFY turn < 12),
drawn AS (SELECT (turn // 2)::BIGINT AS sample, node, turn % 2 + 1 AS place FROM turns),
hop AS (SELECT DISTINCT d.node, x.b FROM (SELECT DISTINCT node FROM drawn) d JOIN und x ON x.a = d.node),
near AS (SELECT node, b FROM hop UNION SELECT h.node, y.b FROM hop h JOIN und y ON y.a = h.b WHERE y.b <> h.node),
few AS (SELECT node, b, row_number() OVER (PARTITION BY node ORDER BY b) AS k FROM near QUALIFY k < 3),
rows_ AS (SELECT sample, place, 0 AS k, node FROM drawn UNION ALL SELECT sample, place, s.k, s.b FROM drawn JOIN few s USING (node)),
first AS (SELECT sample, node, min((place, k)) AS w FROM rows_ GROUP BY sample, node)
SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY w)::INT AS pos, node FROM first""")
def bridging_sample(spark, d):
    e = Scratch(spark, "edges").keep(kg.edges(relations(spark, d)))
    return kg.bridging_sample(e, kg.degree(e), 6, 2, 3, "bridge")


@query()
def connected_samples(spark, d):
    e = Scratch(spark, "edges").keep(kg.edges(relations(spark, d)))
    return kg.ensure_connected(e, kg.bridging_sample(e, kg.degree(e), 6, 3, 2, "connect"))


@query(f"WITH {ENT} SELECT id, name, entity_type FROM ent WHERE entity_type = 'nation'")
def entity_lookup(spark, d):
    ids = t(spark, d, "nation").select(F.concat(F.lit("nation:"), "n_nationkey").alias("id"))
    return kg.get_entity(entities(spark, d), ids).select("id", "name", "entity_type")


MEMBERS = "m AS (SELECT 'region:' || n_regionkey AS sample, 'nation:' || n_nationkey AS node FROM nation UNION ALL SELECT 'region:' || r_regionkey, 'region:' || r_regionkey FROM region)"


def _regions(spark, d):
    n = t(spark, d, "nation").select(F.concat(F.lit("region:"), "n_regionkey").alias("sample"), F.concat(F.lit("nation:"), "n_nationkey").alias("node"))
    r = t(spark, d, "region").select(F.concat(F.lit("region:"), "r_regionkey").alias("sample"), F.concat(F.lit("region:"), "r_regionkey").alias("node"))
    return n.union(r)


@query(f"""WITH {ENT}, {REL}, {MEMBERS},
facts AS (SELECT sample, string_agg('  - ' || name || ' (' || entity_type || '): ' || value, chr(10) ORDER BY node) AS f FROM m JOIN ent ON id = node GROUP BY sample),
links AS (SELECT a.sample, string_agg('  - ' || x.name || ' --[' || k || ']--> ' || y.name || chr(10) || '    Evidence: foreign key', chr(10) ORDER BY s, t, k) AS l FROM rel JOIN m a ON a.node = s JOIN m b ON b.node = t AND b.sample = a.sample JOIN ent x ON x.id = s JOIN ent y ON y.id = t GROUP BY a.sample)
SELECT sample, 'Atomic facts:' || chr(10) || f || chr(10) || chr(10) || 'Relations:' || coalesce(chr(10) || l, '') AS description FROM facts LEFT JOIN links USING (sample)""")
def kg_describe(spark, d):
    return kg.describe(_regions(spark, d), entities(spark, d), relations(spark, d))


@query(f"""WITH {ENT}, {MEMBERS} SELECT sample, string_agg('  • [' || name || '] (' || entity_type || '): ' || value || chr(10) || '    key terms: ' || lower(name) || ', ' || entity_type, chr(10) ORDER BY seq) AS description FROM m JOIN ent ON id = node GROUP BY sample""")
def describe_entities(spark, d):
    e = entities(spark, d).withColumn("key_terms", F.array(F.lower("name"), "entity_type"))
    members = _regions(spark, d).join(e.select(F.col("id").alias("node"), F.col("seq").alias("pos")), "node")
    return kg.describe_entities(members, e.drop("seq"))


PART = "part_ AS (SELECT 'nation:' || n_nationkey AS node, n_regionkey AS c FROM nation UNION ALL SELECT 'region:' || r_regionkey, r_regionkey FROM region UNION ALL SELECT 'customer:' || c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'supplier:' || s_suppkey, s_suppkey % 5 FROM supplier UNION ALL SELECT 'part:' || p_partkey, p_partkey % 5 FROM part)"


@query(f"""WITH {REL}, {PART}, e AS (SELECT a.c AS ca, b.c AS cb FROM (SELECT DISTINCT least(s, t) AS s, greatest(s, t) AS t FROM rel) JOIN part_ a ON a.node = s JOIN part_ b ON b.node = t),
m AS (SELECT count(*) AS m FROM e), deg AS (SELECT c, count(*) AS k FROM (SELECT ca AS c FROM e UNION ALL SELECT cb FROM e) GROUP BY c), inn AS (SELECT ca AS c, count(*) AS l FROM e WHERE ca = cb GROUP BY ca)
SELECT round(sum(coalesce(l, 0) / m.m - (k / (2 * m.m)) ** 2), 6) AS modularity, sum(coalesce(l, 0))::BIGINT AS inner_edges, max(m.m)::BIGINT AS n_edges FROM deg LEFT JOIN inn USING (c), m""")
def kg_modularity(spark, d):
    n, c = t(spark, d, "nation"), t(spark, d, "customer")
    label = lambda kind, key, community, df: df.select(F.concat(F.lit(f"{kind}:"), key).alias("node"), F.col(community).cast("long").alias("community"))
    parts = [label("nation", "n_nationkey", "n_regionkey", n), label("region", "r_regionkey", "r_regionkey", t(spark, d, "region")), label("customer", "c_custkey", "n_regionkey", c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))), label("supplier", "s_suppkey", "c", t(spark, d, "supplier").withColumn("c", F.col("s_suppkey") % 5)), label("part", "p_partkey", "c", t(spark, d, "part").withColumn("c", F.col("p_partkey") % 5))]
    return kg.modularity(kg.edges(relations(spark, d)), sampling.union_all(parts))


@query()
def kg_communities(spark, d):
    return kg.communities(kg.edges(relations(spark, d)))


@query(f"""WITH {REL}, {BOTH}, {MEMBERS}, all_deg AS (SELECT a AS node, count(*) AS degree FROM und GROUP BY a),
cand AS (SELECT DISTINCT m.sample, u.b AS node FROM m JOIN und u ON u.a = m.node WHERE (m.sample, u.b) NOT IN (SELECT (sample, node) FROM m)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY degree DESC, node) AS place FROM cand JOIN all_deg USING (node)),
tail AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY md5('extend|' || node), node) AS pick FROM ranked WHERE place >= 12)
SELECT sample, place::INT AS place, node FROM ranked WHERE place < 12 UNION ALL SELECT sample, 12, node FROM tail WHERE pick = 1""")
def extension_candidates(spark, d):
    return escalation.candidates(kg.edges(relations(spark, d)), entities(spark, d), _regions(spark, d))


@query(f"""WITH {ENT}, {REL}, base AS (SELECT * FROM ent WHERE entity_type <> 'part')
SELECT s AS source_id, t AS target_id, k AS relation_type FROM rel""")
def kg_merge(spark, d):
    """The graph without parts, then all of it, its relations twice."""
    fresh, rel = entities(spark, d), Scratch(spark, "relations").keep(relations(spark, d))
    base = fresh.filter("entity_type <> 'part'")
    have = kg.induced(rel, base)
    return kg.merge(base, have.select(rel.columns), fresh, rel.unionByName(rel))[1].select("source_id", "target_id", "relation_type")


@query("""WITH v(k, ids) AS (VALUES (1, ['nation:3', 'none', 'region:1']), (2, ['x']), (3, ['region:0', 'region:0']))
SELECT * FROM (VALUES (1, 'nation:3,region:1', 'region:2,nation:7'), (2, '', ''), (3, 'region:0,region:0', 'region:3')) w(k, covered, resolved)""")
def id_lists(spark, d):
    v = spark.sql("SELECT * FROM VALUES (1, array('nation:3', 'none', 'region:1'), array('asia', 'nobody', 'NATION_7')), (2, array('x'), CAST(array() AS array<string>)), (3, array('region:0', 'region:0'), array('Europe')) AS v(k, ids, names)")
    e = entities(spark, d)
    kept, found = kg.covered(v, e, "k", "ids"), kg.resolve_name_lists(v, e, "k", "names")
    return kept.toDF("k", "ids").join(found.toDF("k", "named"), "k").select("k", F.array_join("ids", ",").alias("covered"), F.array_join("named", ",").alias("resolved"))


@query(f"WITH {ENT}, names(name) AS (VALUES ('asia'), ('EUROPE'), ('Germany'), ('nowhere')), f AS (SELECT lower(name) AS k, arg_min(id, seq) AS id FROM ent GROUP BY lower(name)) SELECT n.name, f.id FROM names n JOIN f ON f.k = lower(n.name)")
def name_resolution(spark, d):
    return kg.resolve_names(values(spark, "('asia'), ('EUROPE'), ('Germany'), ('nowhere')", "name"), entities(spark, d))


@query(f"""WITH {ENT}, named AS (SELECT n_name AS a, r_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL VALUES ('asia', 'ASIA'))
SELECT a AS source_name, b AS target_name, x.id AS source_id, y.id AS target_id FROM named JOIN (SELECT name, arg_max(id, seq) AS id FROM ent WHERE entity_type = 'nation' GROUP BY name) x ON x.name = a JOIN (SELECT name, arg_max(id, seq) AS id FROM ent WHERE entity_type = 'region' GROUP BY name) y ON y.name = b""")
def edge_resolution(spark, d):
    e = entities(spark, d)
    named = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("source_name"), F.col("r_name").alias("target_name"))
    named = named.union(values(spark, "('asia', 'ASIA')", "a, b"))
    return kg.resolve_edges(named, e.filter("entity_type = 'nation'"), e.filter("entity_type = 'region'")).select("source_name", "target_name", "source_id", "target_id")


@query("""WITH p AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS pos FROM part QUALIFY pos <= 8)
SELECT a.p_brand, a.p_partkey AS a, b.p_partkey AS b, CASE WHEN x.p_size = y.p_size THEN 'Shared terms: size' || x.p_size ELSE 'Same lookup: ' || a.p_brand END AS evidence FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.pos < b.pos JOIN part x ON x.p_partkey = a.p_partkey JOIN part y ON y.p_partkey = b.p_partkey""")
def intra_group_edges(spark, d):
    terms = F.array(F.concat(F.lit("size"), "p_size"), F.concat(F.lit("key"), "p_partkey"))
    ranked = t(spark, d, "part").select("p_brand", "p_partkey", terms.alias("terms")).withColumn("pos", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))).filter("pos <= 8")
    return kg.group_pairs(ranked, "p_brand", "pos", "p_partkey", "terms").select("p_brand", "a", "b", "evidence")


@query("SELECT a.n_nationkey AS i, b.n_nationkey AS j FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey")
def inter_group_pairs(spark, d):
    groups = Scratch(spark, "groups").keep(sampling.ranked(t(spark, d, "nation").select("n_nationkey"), [F.col("n_nationkey")], "place"))
    return kg.all_pairs(groups, "n_nationkey", "place").toDF("i", "j")


@query("""SELECT i, j FROM (SELECT a.n_nationkey AS i, b.n_nationkey AS j, row_number() OVER (PARTITION BY a.n_nationkey ORDER BY md5('cross|' || b.n_nationkey), b.n_nationkey) AS k
FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey <> b.n_regionkey) WHERE k <= 3""")
def cross_topic_partners(spark, d):
    n = t(spark, d, "nation")
    groups = Scratch(spark, "groups").keep(sampling.ranked(n.select("n_nationkey"), [F.col("n_nationkey")], "place"))
    region = n.select("n_nationkey", "n_regionkey")
    pairs = kg.all_pairs(groups, "n_nationkey", "place").toDF("i", "j").join(region.toDF("i", "ri"), "i").join(region.toDF("j", "rj"), "j").filter("ri <> rj")
    return sampling.sample_k(pairs, "j", 3, "cross", ["i"]).select("i", "j")


@query("WITH g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS seq FROM customer GROUP BY c_nationkey, c_mktsegment) SELECT c_nationkey, c_mktsegment, n::BIGINT AS n FROM g QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, seq) = 1")
def largest_group(spark, d):
    groups = t(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"), F.min("c_custkey").alias("seq"))
    return sampling.argmax_first(groups, ["c_nationkey"], "n", "seq").select("c_nationkey", "c_mktsegment", "n")


# ---- statistics ----------------------------------------------------------------


@query("SELECT coalesce(lang, 'unknown') AS lang, count(*)::BIGINT AS n, round(100 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM documents GROUP BY 1")
def stats_distribution(spark, d):
    return stats.distribution(t(spark, d, "documents"), "lang", "lang")


@query("SELECT round(avg(length(text)), 4) AS text_mean, min(length(text))::BIGINT AS text_min, max(length(text))::BIGINT AS text_max, round(avg(length(source)), 4) AS source_mean, min(length(source))::BIGINT AS source_min, max(length(source))::BIGINT AS source_max FROM documents")
def stats_lengths(spark, d):
    return stats.lengths(t(spark, d, "documents"), text="text", source="source")


@query("SELECT count(*) FILTER (WHERE quality IS NULL)::BIGINT AS from_corpus, count(*) FILTER (WHERE quality IS NOT NULL)::BIGINT AS from_graph FROM documents LEFT JOIN labels USING (doc_id)")
def stats_source_split(spark, d):
    return stats.source_split(t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left"), "quality")


@query("SELECT event_type AS tool, count(*)::BIGINT AS n FROM (SELECT DISTINCT user_id, ts::DATE, event_type FROM events) GROUP BY 1")
def tool_distribution(spark, d):
    used = t(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set("event_type").alias("tools"))
    return stats.exploded_distribution(used, "tools", "tool")


@query("WITH h AS (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n FROM conversations GROUP BY 1) SELECT count(*) FILTER (WHERE n > 0)::BIGINT AS with_history, round(avg(n) FILTER (WHERE n > 0), 4) AS mean_depth FROM h")
def escalation_depth(spark, d):
    h = t(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.when(F.col("role") == "assistant", F.col("turn"))).alias("history"))
    return stats.depth(h, "history")


@query("SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' ELSE 'source' END AS by, coalesce(lang, source) AS key, count(*)::BIGINT AS n, round(avg(length(text)), 4) AS mean_chars FROM documents GROUP BY GROUPING SETS ((lang), (source))")
def run_summary(spark, d):
    return stats.run_summary(t(spark, d, "documents"), "lang", "source", "text")


@query("""WITH x AS (SELECT DISTINCT source, doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS item FROM documents), m AS (SELECT source, count(DISTINCT doc_id) AS k FROM documents GROUP BY 1)
SELECT source, item, count(*)::BIGINT AS n FROM x JOIN m USING (source) GROUP BY source, item, k HAVING count(*) >= 2 OR count(*) = k""")
def shared_entities(spark, d):
    """A document without an entity still counts as a member of its source."""
    docs = t(spark, d, "documents")
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{3,})"), F.lit(1)))
    return stats.shared_items(docs.select("source", "doc_id", F.explode_outer(words).alias("item")), "source", "doc_id", "item")


@query("SELECT source, count(*)::BIGINT AS n_docs, sum(n_chars)::BIGINT AS chars, (sum(length(text)) // 4)::BIGINT AS tokens FROM documents GROUP BY 1")
def corpus_metadata(spark, d):
    return t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("chars"), F.expr("sum(length(text)) div 4").alias("tokens"))


@query("SELECT doc_id, (length(text) // 4)::BIGINT AS tokens FROM documents")
def token_estimate(spark, d):
    return t(spark, d, "documents").select("doc_id", stats.token_estimate(F.col("text")).alias("tokens"))


# ---- quality -------------------------------------------------------------------

VERDICT = "CASE WHEN toxic = 1 THEN 'TOO_EASY' WHEN quality <> 1 THEN 'TOO_HARD' WHEN dup THEN 'DUPLICATE' ELSE 'PASS' END"
JUDGED = f"j AS (SELECT doc_id, source, {VERDICT} AS verdict FROM (SELECT d.*, l.quality, l.toxic, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS dup FROM documents d JOIN labels l USING (doc_id)))"


def _judged(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("digest")).join(t(spark, d, "labels"), "doc_id")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    rows = rows.join(first, "digest")
    return rows.select("doc_id", "source", quality.verdict(F.col("toxic") == 1, F.col("quality") == 1, F.col("doc_id") > F.col("first")).alias("verdict"))


@query(f"WITH {JUDGED} SELECT doc_id, verdict FROM j")
def verdict_cascade(spark, d):
    return _judged(spark, d).select("doc_id", "verdict")


@query(f"WITH {JUDGED} SELECT verdict, count(*)::BIGINT AS n, round(100 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM j GROUP BY 1")
def verdict_distribution(spark, d):
    return stats.distribution(_judged(spark, d), "verdict", "verdict")


@query(f"WITH {JUDGED}, g AS (SELECT doc_id // 100 AS batch, verdict, count(*) AS n FROM j GROUP BY ALL) SELECT batch, verdict, n::BIGINT AS n, (sum(n) OVER (PARTITION BY verdict ORDER BY batch))::BIGINT AS total FROM g")
def batch_running_verdicts(spark, d):
    return stats.running_counts(_judged(spark, d).withColumn("batch", F.expr("doc_id div 100")), "batch", "verdict")


@query(f"WITH {JUDGED} SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM j WHERE verdict = 'PASS')")
def pass_filter(spark, d):
    return t(spark, d, "documents").select("doc_id", "lang").join(_judged(spark, d).filter("verdict = 'PASS'").select("doc_id"), "doc_id", "left_semi")


@query(f"WITH {JUDGED} SELECT batch, doc_id, k AS place FROM (SELECT doc_id // 50 AS batch, doc_id, row_number() OVER (PARTITION BY doc_id // 50 ORDER BY doc_id)::INT AS k FROM j WHERE verdict = 'PASS') WHERE k <= 5")
def first_n_successes(spark, d):
    rows = _judged(spark, d).withColumn("batch", F.expr("doc_id div 50"))
    return sampling.first_n(rows, 5, "doc_id", ["batch"], F.col("verdict") == "PASS").select("batch", "doc_id", "place")


GRID = "(CAST(NULL AS DOUBLE)), (0.0D), (0.1D), (0.25D), (0.4D), (0.44D), (0.45D), (0.5D), (0.55D), (0.56D), (0.7D), (0.95D), (1.0D)"
SQL_GRID = "g(c) AS (VALUES (NULL::DOUBLE), (0.0), (0.1), (0.25), (0.4), (0.44), (0.45), (0.5), (0.55), (0.56), (0.7), (0.95), (1.0))"
STRICT = "CASE WHEN c IS NULL THEN 'strict' WHEN c < 0.45 THEN 'lenient_paraphrase' WHEN c <= 0.55 THEN 'strict' ELSE 'lenient_partial' END"


@query(f"WITH {SQL_GRID} SELECT c::DOUBLE AS c, {STRICT} AS strictness FROM g")
def judge_strictness(spark, d):
    return values(spark, GRID, "c").select("c", quality.strictness(F.col("c")).alias("strictness"))


@query(f"""WITH {SQL_GRID}, h AS (SELECT c::DOUBLE AS c FROM g) SELECT c, coalesce(trunc(2 + 4 * c), 2)::BIGINT AS walk_min, coalesce(trunc(4 + 8 * c), 6)::BIGINT AS walk_max, coalesce(trunc(10 + 20 * c), 10)::BIGINT AS walk_steps,
coalesce(round_even(2 + 2 * c, 0), 2)::BIGINT AS bridge_seeds, coalesce(round_even(2 + 2 * c, 0), 2)::BIGINT AS bridge_each, 1::BIGINT AS esc_rounds, coalesce(trunc(8 + 4 * c), 10)::BIGINT AS qc_max, {STRICT} AS strictness FROM h""")
def complexity_params(spark, d):
    return quality.complexity_params(values(spark, GRID, "c"))


AFFINITY = "s(strategy, a) AS (VALUES ('hop_extension', 0.1::DOUBLE), ('subgraph_bridging', 0.8), ('multi_entity_aggregation', 0.7), ('constraint_chain', 0.5), ('inverse_reasoning', 0.4))"


@query(f"WITH {SQL_GRID}, {AFFINITY}, w AS (SELECT c::DOUBLE AS c, strategy, greatest(0.05, a * c::DOUBLE + (1 - a) * (1 - c::DOUBLE)) AS raw FROM g, s WHERE c IS NOT NULL) SELECT c, strategy, round(raw / sum(raw) OVER (PARTITION BY c), 6) AS weight FROM w")
def strategy_weights(spark, d):
    return quality.strategy_weights(values(spark, GRID, "c"))


@query(f"""WITH {AFFINITY}, w AS (SELECT strategy, round(greatest(0.05, a * 0.7 + (1 - a) * 0.3), 3)::DOUBLE AS weight FROM s), e AS (SELECT strategy, sum(weight) OVER (ORDER BY strategy) / sum(weight) OVER () AS high FROM w),
u AS (SELECT doc_id AS draw, ('0x' || substr(md5('choice|' || doc_id), 1, 8))::BIGINT / 4294967296 AS u FROM documents) SELECT draw, arg_min(strategy, high) AS item FROM u JOIN e ON u < high GROUP BY draw""")
def weighted_choice(spark, d):
    one = values(spark, "(0.7D)", "c")
    names = F.array(*[F.struct(F.lit(k).alias("item"), F.lit(round(max(0.05, a * 0.7 + (1 - a) * 0.3), 3)).alias("weight")) for k, a in quality.STRATEGY_AFFINITY.items()])
    weights = one.select(F.explode(names).alias("s")).select("s.*")
    return quality.weighted_choice(t(spark, d, "documents").select(F.col("doc_id").alias("draw")), weights, "choice")


# ---- vectors -------------------------------------------------------------------

def _pairs(spark, d, threshold=0.3):
    return similarity.similar_pairs(t(spark, d, "embeddings"), "vec_id", "embedding", threshold)


def _dealt(spark, d):
    return similarity.Dealt(t(spark, d, "embeddings"), "vec_id", "embedding")


def _counted(spark, d):
    return similarity.neighbour_counts(_dealt(spark, d), 0.3, 0.3)


@query(f"WITH {PAIRS} SELECT a, b, round(sim, 5) AS sim FROM p WHERE sim >= 0.3")
def pairwise_cosine(spark, d):
    return _pairs(spark, d).withColumn("sim", F.round("sim", 5))


@query("SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_function(spark, d):
    e = t(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("v"))
    return e.select(F.col("vec_id").alias("a"), "embedding").join(b, "a").select("a", "b", F.round(similarity.cosine(F.col("embedding"), F.col("v")), 5).alias("sim"))


@query(f"WITH {PAIRS}, e AS (SELECT a AS id FROM p WHERE sim > 0.3 UNION ALL SELECT b FROM p WHERE sim > 0.3) SELECT vec_id AS id, (SELECT count(*) FROM e WHERE e.id = vec_id)::BIGINT AS n FROM embeddings")
def connectivity(spark, d):
    return _counted(spark, d)


@query(f"WITH {PAIRS}, e AS (SELECT a AS id FROM p WHERE sim > 0.3 UNION ALL SELECT b FROM p WHERE sim > 0.3), c AS (SELECT vec_id AS id, (SELECT count(*) FROM e WHERE e.id = vec_id) AS n FROM embeddings) SELECT id, n::BIGINT AS n, row_number() OVER (ORDER BY n DESC, id)::INT AS place FROM c")
def anchor_order(spark, d):
    return similarity.anchor_order(_counted(spark, d))


@query("SELECT a.label, round(avg(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])), 4) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1")
def group_score(spark, d):
    return similarity.group_score(t(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query(f"""WITH {PAIRS} SELECT a, b, round(sim + CASE WHEN x.label <> y.label THEN 0.1 ELSE 0 END + 0.05 * (CASE WHEN a % 4 = b % 4 THEN 1 ELSE 0 END + CASE WHEN a % 3 = b % 3 THEN 1 ELSE 0 END), 5) AS score
FROM p JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b WHERE sim >= 0.3""")
def candidate_score(spark, d):
    return similarity.scored_pairs(_chunks(spark, d), 0.3).withColumn("score", F.round("score", 5))


def _chunks(spark, d):
    entities_ = F.array(F.concat(F.lit("four"), F.col("vec_id") % 4), F.concat(F.lit("three"), F.col("vec_id") % 3))
    return t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), F.col("label").alias("source"), entities_.alias("entities"))


@query(f"""WITH RECURSIVE {PAIRS}, n AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS k FROM embeddings), near AS (SELECT b AS v, list(a) AS earlier FROM p WHERE sim >= 0.3 GROUP BY b),
fold(k, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT n.k, CASE WHEN len(list_intersect(f.kept, coalesce(near.earlier, []))) = 0 THEN list_append(f.kept, n.vec_id) ELSE f.kept END FROM fold f JOIN n ON n.k = f.k + 1 LEFT JOIN near ON near.v = n.vec_id)
SELECT unnest(kept) AS id FROM fold WHERE k = (SELECT max(k) FROM n)""")
def greedy_dedup(spark, d):
    return similarity.greedy_vectors(t(spark, d, "embeddings"), "vec_id", "embedding", 0.3)


@query(f"WITH {PAIRS} SELECT DISTINCT CASE WHEN a % 2 = 1 THEN a ELSE b END AS id FROM p WHERE sim >= 0.3 AND a % 2 <> b % 2")
def duplicate_probe(spark, d):
    e = t(spark, d, "embeddings")
    return similarity.probe(e.filter("vec_id % 2 = 1"), e.filter("vec_id % 2 = 0"), "vec_id", "embedding", 0.3)


@query()
def composite_units(spark, d):
    return similarity.vector_units(_chunks(spark, d), 0.3, 3)


# ---- texts, pages, keys --------------------------------------------------------


@query(r"WITH s AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents) SELECT doc_id, length(substr(t, 1, 8000))::BIGINT AS n, md5(substr(t, 1, 8000)) AS digest FROM s WHERE length(t) > 200")
def corpus_load_filter(spark, d):
    s = t(spark, d, "documents").select("doc_id", text.strip(F.col("text")).alias("t")).filter(F.length("t") > 200)
    return s.select("doc_id", F.length(F.substring("t", 1, 8000)).cast("long").alias("n"), F.md5(F.substring("t", 1, 8000).cast("binary")).alias("digest"))


@query("SELECT doc_id, length(coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE substr(text, 1, 50) END, ''), text))::BIGINT AS n FROM documents")
def chunk_text_fallback(spark, d):
    docs = t(spark, d, "documents").withColumn("summary", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.substring("text", 1, 50)))
    return docs.select("doc_id", F.length(F.coalesce(F.nullif("summary", F.lit("")), "text")).cast("long").alias("n"))


CLEAN = r"regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<nav\b[^>]*>.*?</nav\s*>|<header\b[^>]*>.*?</header\s*>|<footer\b[^>]*>.*?</footer\s*>|<aside\b[^>]*>.*?</aside\s*>|<!--.*?-->', '', 'g')"
MARKS = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&eacute;", "é"), ("&nbsp;", " "), ("&#39;", "''"), ("&amp;", "&"))
CLEAN = f"regexp_replace({CLEAN}, '<[^>]+>', chr(10), 'g')"
for _name, _char in MARKS:
    CLEAN = f"replace({CLEAN}, '{_name}', '{_char}')"


@query(rf"WITH l AS (SELECT page_id, list_filter(list_transform(string_split({CLEAN}, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines FROM pages) SELECT page_id, md5(array_to_string(lines, chr(10))) AS digest, length(array_to_string(lines, chr(10)))::BIGINT AS n FROM l")
def page_clean(spark, d):
    c = t(spark, d, "pages").select("page_id", text.page_text(F.col("html")).alias("x"))
    return c.select("page_id", F.md5(F.col("x").cast("binary")).alias("digest"), F.length("x").cast("long").alias("n"))


@query("SELECT * FROM (VALUES (0, 'A &amp; B <i>' || chr(10) || 'tail'), (1, 'Tést’s' || chr(10) || 'A…'), (2, ''), (3, 'plain')) v(k, said)")
def page_clean_cases(spark, d):
    pages = ["<p>A &amp;amp; B &lt;i&gt;</p><script>x</script> tail", "<nav>menu</nav><h1>T&eacute;st&#8217;s</h1>\n\n <!-- no --><p> &#x41;&hellip; </p>", "<footer>f</footer>", "plain"]
    ship(spark)
    return spark.createDataFrame(list(enumerate(pages)), "k int, html string").select("k", text.page_text(F.col("html")).alias("said"))


@query(r"SELECT page_id, regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '^\s+|\s+$', '', 'g') AS title FROM pages")
def page_title(spark, d):
    return t(spark, d, "pages").select("page_id", text.page_title(F.col("html")).alias("title"))


@query("SELECT page_id, substr(sha256(url || '|' || 'goal'), 1, 16) AS visit_key, substr(sha256(lower(url)), 1, 16) AS lookup_key FROM pages")
def cache_keys(spark, d):
    return t(spark, d, "pages").select("page_id", text.cache_key(F.col("url"), F.lit("goal")).alias("visit_key"), text.cache_key(F.lower("url")).alias("lookup_key"))


@query("""WITH s AS (SELECT p_partkey, (CASE WHEN contains(x, 'steel') THEN 1 ELSE 0 END + CASE WHEN contains(x, 'small') THEN 1 ELSE 0 END + CASE WHEN contains(x, 'small steel') THEN 2 ELSE 0 END)::BIGINT AS score
FROM (SELECT p_partkey, lower(p_name || ' ' || p_brand || ' ' || p_type) AS x FROM part)) SELECT p_partkey, score FROM s WHERE score > 0 ORDER BY score DESC, p_partkey LIMIT 10""")
def kb_search(spark, d):
    return text.kb_search(t(spark, d, "part"), "small steel", ["p_name", "p_brand", "p_type"], "p_partkey").select("p_partkey", "score")


@query("""WITH s AS (SELECT doc_id, (CASE WHEN contains(lower(text), 'thing') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'clown') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'thing clown') THEN 2 ELSE 0 END)::BIGINT AS score FROM documents)
SELECT doc_id, score FROM s WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 10""")
def web_search_offline(spark, d):
    return text.kb_search(t(spark, d, "documents"), "thing clown", ["text"], "doc_id").select("doc_id", "score")


SAID = r"""('Thought.\nTOOL_CALL: Wikipedia | Silk Road'), ('no call'), ('TOOL_CALL:search|a | b\nmore'), ('TOOL_CALL: x |  padded  ')"""


@query(r"WITH s(x) AS (VALUES ('Thought.' || chr(10) || 'TOOL_CALL: Wikipedia | Silk Road'), ('no call'), ('TOOL_CALL:search|a | b' || chr(10) || 'more'), ('TOOL_CALL: x |  padded  ')) SELECT x, nullif(lower(regexp_extract(x, 'TOOL_CALL:\s*(\w+)\s*\|\s*(.+)', 1)), '') AS tool, nullif(trim(regexp_extract(x, 'TOOL_CALL:\s*(\w+)\s*\|\s*(.+)', 2)), '') AS query FROM s")
def tool_call_parse(spark, d):
    return values(spark, SAID, "x").select("x", *text.tool_call(F.col("x")))


@query("""WITH s(k, x) AS (VALUES (1, '{"answer": "a"}'), (2, 'so:' || chr(10) || '```json' || chr(10) || '{"answer": "b"}' || chr(10) || '```'), (3, 'well {"answer": "c"} end'), (4, 'none'), (5, '{"other": 1}'))
SELECT k, CASE k WHEN 1 THEN '{"answer": "a"}' WHEN 2 THEN '{"answer": "b"}' WHEN 3 THEN '{"answer": "c"}' END AS json FROM s""")
def json_rescue(spark, d):
    rows = r"""(1, '{"answer": "a"}'), (2, 'so:\n```json\n{"answer": "b"}\n```'), (3, 'well {"answer": "c"} end'), (4, 'none'), (5, '{"other": 1}')"""
    return values(spark, rows, "k, x").select("k", text.json_rescue(F.col("x"), "answer").alias("json"))


@query("SELECT * FROM (VALUES ('https://a.b|what is it', 'https://a.b', 'what is it'), ('https://a.b', 'https://a.b', ''), ('u|x|y', 'u', 'x|y')) v(q, url, goal)")
def url_goal_split(spark, d):
    return values(spark, "('https://a.b|what is it'), ('https://a.b'), ('u|x|y')", "q").select("q", *text.url_and_goal(F.col("q")))


@query("SELECT * FROM (VALUES ('2-4', 1, 4), ('3', 2, 3), ('x', 0, 10), ('9-99', 8, 10), ('0-2', 0, 2)) v(r, first, last)")
def page_range(spark, d):
    return values(spark, "('2-4'), ('3'), ('x'), ('9-99'), ('0-2')", "r").select("r", *text.page_range(F.col("r"), F.lit(10)))


@query("SELECT n_nationkey, 'Hello {' || n_name || '} of ' || n_regionkey AS said, lower(replace('geo ' || n_name, ' ', '_')) || '.txt' AS slug, '- [' || n_name || ']: ' || n_regionkey AS fact FROM nation")
def prompt_render(spark, d):
    n = t(spark, d, "nation")
    return n.select("n_nationkey", text.prompt("Hello {{{name}}} of {region}", name=F.col("n_name"), region=F.col("n_regionkey")).alias("said"), text.slug(F.lit("geo"), F.col("n_name")).alias("slug"), text.fact_line(F.col("n_name"), F.col("n_regionkey").cast("string")).alias("fact"))


@query("""WITH x AS (SELECT c_mktsegment, n_name, count(*) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 3 GROUP BY ALL)
SELECT c_mktsegment AS segment, rpad(coalesce(max(CASE WHEN n_nationkey = 0 THEN k END)::VARCHAR, 'N/A'), 25, ' ') AS c0, rpad(coalesce(max(CASE WHEN n_nationkey = 1 THEN k END)::VARCHAR, 'N/A'), 25, ' ') AS c1
FROM x JOIN nation USING (n_name) GROUP BY 1""")
def comparison_pivot(spark, d):
    c = t(spark, d, "customer").filter("c_nationkey < 3").groupBy(F.col("c_mktsegment").alias("segment")).pivot("c_nationkey", [0, 1]).agg(F.count("c_custkey"))
    return c.select("segment", text.comparison(F.col("0").cast("string")).alias("c0"), text.comparison(F.col("1").cast("string")).alias("c1"))


# ---- dates, units, calculator ---------------------------------------------------


@query("SELECT o_orderkey, abs(date_diff('day', o_orderdate::DATE, DATE '1995-06-17'))::BIGINT AS days, (abs(date_diff('day', o_orderdate::DATE, DATE '1995-06-17')) // 365)::BIGINT AS years, ((abs(date_diff('day', o_orderdate::DATE, DATE '1995-06-17')) % 365) // 30)::BIGINT AS months, ((abs(date_diff('day', o_orderdate::DATE, DATE '1995-06-17')) % 365) % 30)::BIGINT AS rest FROM orders")
def date_diff(spark, d):
    return t(spark, d, "orders").select("o_orderkey", *dates.diff(F.to_date("o_orderdate"), F.lit("1995-06-17").cast("date")))


@query("""SELECT o_orderkey, strftime(o_orderdate::DATE + 10, '%Y-%m-%d') AS by_day, strftime(o_orderdate::DATE + 21, '%Y-%m-%d') AS by_week,
strftime(make_date(year(o_orderdate) + (month(o_orderdate) + 4) // 12, (month(o_orderdate) + 4) % 12 + 1, least(day(o_orderdate), 28)), '%Y-%m-%d') AS by_month,
CASE WHEN strftime(o_orderdate, '%m-%d') = '02-29' AND NOT ((year(o_orderdate) + 1) % 4 = 0) THEN NULL ELSE (year(o_orderdate) + 1) || strftime(o_orderdate, '-%m-%d') END AS by_year FROM orders""")
def date_add(spark, d):
    o, day = t(spark, d, "orders"), F.to_date("o_orderdate")
    made = lambda n, unit: F.date_format(dates.add(day, F.lit(n), F.lit(unit)), "yyyy-MM-dd")
    return o.select("o_orderkey", made(10, "day").alias("by_day"), made(3, "week").alias("by_week"), made(5, "month").alias("by_month"), made(1, "year").alias("by_year"))


@query("""WITH s AS (SELECT l_suppkey, min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS b FROM lineitem GROUP BY 1)
SELECT x.l_suppkey, (x.a <= DATE '1996-12-31' AND DATE '1996-01-01' <= x.b) AS overlaps,
CASE WHEN x.a <= DATE '1996-12-31' AND DATE '1996-01-01' <= x.b THEN date_diff('day', greatest(x.a, DATE '1996-01-01'), least(x.b, DATE '1996-12-31')) ELSE abs(date_diff('day', greatest(x.b, DATE '1996-12-31'), least(x.a, DATE '1996-01-01'))) END::BIGINT AS days FROM s x""")
def date_overlap(spark, d):
    s = t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b"))
    return s.select("l_suppkey", *dates.overlap(F.col("a"), F.col("b"), F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey)::INT AS place FROM orders")
def date_order(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return dates.chronological(o, "day", "o_orderkey", ["o_custkey"]).select("o_custkey", "o_orderkey", "place")


@query("SELECT * FROM (VALUES ('2020-03-04', '2020-03-04'), ('2020/3/4', '2020-03-04'), ('1999', '1999-01-01'), ('12/31/2001', '2001-12-31'), ('31-12-2001', '2001-12-31'), ('March 5, 2010', '2010-03-05'), ('Mar 5, 2010', '2010-03-05'), ('44 BCE', '0044-01-01'), ('2020-13-01', NULL), ('soon', NULL)) v(x, parsed)")
def date_parse(spark, d):
    v = values(spark, "('2020-03-04'), ('2020/3/4'), ('1999'), ('12/31/2001'), ('31-12-2001'), ('March 5, 2010'), ('Mar 5, 2010'), ('44 BCE'), ('2020-13-01'), ('soon')", "x")
    return v.select("x", F.date_format(dates.parse(F.col("x")), "yyyy-MM-dd").alias("parsed"))


@query("SELECT p_partkey, round(p_size * 0.0254 / 0.3048, 6) AS feet, round((p_size - 32) * 5 / 9, 6) AS celsius FROM part")
def unit_convert(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("amount"), F.lit("inch").alias("source"), F.lit("ft").alias("target"))
    made = units.convert(p)
    return made.select("p_partkey", F.round("converted", 6).alias("feet"), F.round(units.temperature(F.col("amount"), F.lit("F"), F.lit("celsius")), 6).alias("celsius"))


@query("SELECT * FROM (VALUES ('13.6 eV to J', '2.17896e-18', NULL), ('100 C to F', '212', NULL), ('1 kg to m', NULL, 'cannot convert mass to length'), ('2 foo to m', NULL, 'unknown unit'), ('2 km in mile', '1.24274', NULL)) v(request, shown, problem)")
def unit_requests(spark, d):
    v = values(spark, "('13.6 eV to J'), ('100 C to F'), ('1 kg to m'), ('2 foo to m'), ('2 km in mile')", "request")
    made = units.convert(v.select("request", *units.parse(F.col("request"))))
    shown = F.pandas_udf(lambda s: s.map(lambda x: None if x != x else f"{x:.6g}"), StringType())
    return made.select("request", shown("converted").alias("shown"), "problem")


@query("SELECT * FROM (VALUES ('sqrt(144) + log10(100)', '14.0'), ('-7 // 4', '-2'), ('2 ** 10', '1024'), ('sum([1, 2, 3]) * pi', '18.84955592153876'), ('gcd(12, 18)', '6')) v(x, result)")
def calculator(spark, d):
    v = values(spark, "('sqrt(144) + log10(100)'), ('-7 // 4'), ('2 ** 10'), ('sum([1, 2, 3]) * pi'), ('gcd(12, 18)')", "x")
    return v.select("x", calc.calculator("x").alias("result"))


@query("SELECT * FROM (VALUES (0, 0, 'Kings', 'name', 'Ann'), (0, 0, 'Kings', 'year', '1700'), (0, 1, 'Kings', 'name', 'Bob'), (0, 1, 'Kings', 'year', '1800')) v(table_no, row_no, caption, header, value)")
def table_extract(spark, d):
    spark.udtf.register("extract_tables", tables.ExtractTables)
    page = "<h2>Kings</h2><table><tr><th>name<th>year</tr><tr><td>Ann<td>1700</tr><tr><td>short</tr><tr><td>Bob</td><td>1800</td></tr></table>"
    return spark.sql(f"SELECT x.* FROM (SELECT '{page}' AS page) p, LATERAL extract_tables(p.page, CAST(NULL AS STRING)) x")


# ---- bundles, logs, lists -------------------------------------------------------


@query("SELECT doc_id AS id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN lang ELSE 'new' END AS lang FROM documents")
def bundle_upsert(spark, d):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    there = docs.join(t(spark, d, "labels").select(F.col("doc_id").alias("id")), "id", "left_semi")
    return files.bundle_upsert(there, docs.withColumn("lang", F.lit("new")))


@query("SELECT doc_id AS id, CASE WHEN l.doc_id IS NULL THEN d.lang WHEN quality = 1 THEN 'good' ELSE '' END AS lang FROM documents d LEFT JOIN labels l USING (doc_id)")
def bundle_enrich(spark, d):
    update = t(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "good").alias("lang"))
    return files.bundle_enrich(t(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang"), update, ["lang"])


@query(f"""WITH {ENT}, {REL} SELECT 'entity' AS kind, seq::BIGINT AS seq, '{{"id":"' || id || '","name":"' || name || '"}}' AS json FROM ent
UNION ALL SELECT 'relation', CASE WHEN s LIKE 'nation:%' THEN 0 WHEN s LIKE 'customer:%' THEN 1000000000 WHEN s LIKE 'supplier:%' THEN 2000000000 ELSE 10000000000000 END
  + CASE WHEN k = 'supplied_by' THEN split_part(s, ':', 2)::BIGINT * 10000000 + split_part(t, ':', 2)::BIGINT ELSE split_part(s, ':', 2)::BIGINT END,
  '{{"source_id":"' || s || '","target_id":"' || t || '","relation_type":"' || k || '"}}' FROM rel""")
def kg_serialise(spark, d):
    return files.serialised(entities(spark, d).select("id", "name", "seq"), relations(spark, d).drop("evidence"))


@query("SELECT conv_id AS qa_id, turn AS step_no, role, text AS content FROM conversations WHERE role = 'assistant'")
def trajectory_steps(spark, d):
    return t(spark, d, "conversations").filter("role = 'assistant'").select(F.col("conv_id").alias("qa_id"), F.col("turn").alias("step_no"), "role", F.col("text").alias("content"))


@query("SELECT conv_id AS qa_id, count(*)::BIGINT AS steps, count(*) FILTER (WHERE role = 'assistant')::BIGINT AS replies, arg_max(text, turn) AS last FROM conversations GROUP BY 1")
def trajectory_summary(spark, d):
    c = t(spark, d, "conversations").groupBy(F.col("conv_id").alias("qa_id"))
    return c.agg(F.count("*").alias("steps"), F.count_if(F.col("role") == "assistant").alias("replies"), F.max_by("text", "turn").alias("last"))


@query("SELECT event_id, substr(props, 1, 200) AS props, round(value, 1) AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")
def log_tail(spark, d):
    return t(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(200).select("event_id", F.substring("props", 1, 200).alias("props"), F.round("value", 1).alias("value"))


@query("SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events) WHERE k <= CASE event_type WHEN 'click' THEN 8 WHEN 'view' THEN 4 ELSE 6 END")
def fact_cap(spark, d):
    cap = F.when(F.col("event_type") == "click", 8).when(F.col("event_type") == "view", 4).otherwise(6)
    ranked = t(spark, d, "events").withColumn("k", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))).filter("k <= 8")
    return ranked.filter(F.col("k") <= cap).select("event_type", "event_id")


@query("SELECT page_id, url FROM pages WHERE url <> '' AND html <> '' ORDER BY page_id LIMIT 3")
def usable_results(spark, d):
    return t(spark, d, "pages").filter("url <> '' and html <> ''").orderBy("page_id").limit(3).select("page_id", "url")


@query("SELECT DISTINCT lower(split_part(n_name, ' ', 1)) AS seed FROM nation WHERE lower(n_name) NOT IN (SELECT lower(n_name) FROM nation WHERE n_regionkey = 1)")
def new_seeds(spark, d):
    n = t(spark, d, "nation")
    known = n.filter("n_regionkey = 1").select(F.lower("n_name").alias("k"))
    return n.withColumn("k", F.lower("n_name")).join(known, "k", "left_anti").select(F.lower(F.split("n_name", " ")[0]).alias("seed")).distinct()


@query("SELECT doc_id FROM documents ORDER BY md5('pick|' || doc_id), doc_id LIMIT 25")
def sample_without_replacement(spark, d):
    return sampling.sample_k(t(spark, d, "documents").select("doc_id"), "doc_id", 25, "pick")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'walk' ELSE 'bridge' END AS strategy FROM documents")
def alternation(spark, d):
    return t(spark, d, "documents").select("doc_id", F.when(F.pmod("doc_id", F.lit(2)) == 0, "walk").otherwise("bridge").alias("strategy"))


@query("SELECT * FROM (VALUES (1, 'c,a,b,d', 'search,wikipedia', 'a', 'a,x,b,y'), (2, 'x', 'python,calc', '', 'x')) v(k, merged, tools, shared, united)")
def list_operations(spark, d):
    v = spark.sql("SELECT * FROM VALUES (1, array('c','a'), array('a','b','d'), array('wikipedia','search','z'), array('a','x'), array('a','b','y')), (2, array('x'), CAST(array() AS array<string>), array('python','calc','q'), array('x'), CAST(array() AS array<string>)) AS v(k, a, b, tools, p, q)")
    order = F.array(F.lit("search"), F.lit("wikipedia"), F.lit("scholar"))
    preferred = F.array_intersect(order, "tools")
    join = lambda x: F.array_join(x, ",")
    return v.select("k", join(F.array_distinct(F.concat("a", "b"))).alias("merged"), join(F.when(F.size(preferred) > 0, preferred).otherwise(F.slice("tools", 1, 2))).alias("tools"), join(F.array_intersect("p", "q")).alias("shared"), join(F.array_union(F.array_union("p", F.filter("q", lambda x: x == "b")), "q")).alias("united"))


@query("SELECT region.r_name AS category, n_name AS seed FROM nation JOIN region ON n_regionkey = r_regionkey")
def seed_list(spark, d):
    n = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    packed = n.groupBy("r_name").agg(F.collect_list("n_name").alias("all")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("r_name", "all")))).alias("json"))
    return files.seeds(packed, "json").select("category", "seed")


@query("SELECT c_custkey AS id, 'customer' AS track FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def track_union(spark, d):
    return sampling.union_all([t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("track")), t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("track"))])


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem GROUP BY ALL")
def composite_distinct(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").dropDuplicates()


@query("SELECT doc_id, coalesce(l.quality::VARCHAR, d.source) AS subgraph FROM documents d LEFT JOIN labels l USING (doc_id)")
def subgraph_ids(spark, d):
    j = t(spark, d, "documents").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.select("doc_id", F.coalesce(F.col("quality").cast("string"), "source").alias("subgraph"))


# ---- providers, tracks, streams -------------------------------------------------


@query("WITH w AS (SELECT source, doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS term FROM documents) SELECT lower(term) AS term, arg_min(source, (doc_id, source)) AS lineage FROM w GROUP BY 1")
def seed_lineage(spark, d):
    docs = t(spark, d, "documents")
    w = docs.select("source", "doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{3,})"), F.lit(1)))).alias("term"))
    return w.groupBy(F.lower("term").alias("term")).agg(F.min_by("source", F.struct("doc_id", "source")).alias("lineage"))


@query()
def fact_atomiser(spark, d):
    return providers.atomise(t(spark, d, "documents"), "doc_id", "text", 6)


@query()
def frontier_expansion(spark, d):
    docs = t(spark, d, "documents").select(F.lower(F.regexp_extract("text", r"\w+", 0)).alias("topic"), "text")
    return tracks.build_rounds(docs, values(spark, "('Anat'), ('The'), ('Thnt')", "seed"), 3, 40)[1]


@query()
def graph_track(spark, d):
    return tracks.graph_track(entities(spark, d), relations(spark, d), 60, "track", 0.4, rounds=1)


@query("SELECT strftime(ts::DATE, '%Y-%m-%d 00:00:00') AS window_start, event_type AS tool, count(*)::BIGINT AS n, round(avg(value), 4) AS mean_value, max(value) AS max_value FROM events GROUP BY 1, 2")
def windowed_latency(spark, d):
    return events.window_latency(t(spark, d, "events"))


@query("""WITH x AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
y AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM x) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*)::BIGINT AS n FROM y GROUP BY user_id, s""")
def user_sessions(spark, d):
    return events.sessions(t(spark, d, "events"))


# ---- cascade, escalation, corpus track --------------------------------------------

ORDERS = """q AS (SELECT 'order:' || lpad(o_orderkey::VARCHAR, 9, '0') AS qa_id, 'Which customer ordered on ' || strftime(o_orderdate, '%Y-%m-%d') || ' at priority ' || o_orderpriority || '?' AS question, c_name AS answer, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS pri FROM orders JOIN customer ON c_custkey = o_custkey
  UNION ALL SELECT 'none:' || r_regionkey, 'Which customer is in ' || r_name || '?', NULL, NULL, NULL, NULL FROM region)"""


@query(f"""WITH {ORDERS}, n AS (SELECT answer, count(*) AS n FROM q WHERE answer IS NOT NULL GROUP BY 1), popular AS (SELECT answer AS p FROM n ORDER BY n DESC, answer LIMIT 1),
first AS (SELECT day, pri, min(answer) AS f FROM q GROUP BY day, pri),
told AS (SELECT q.*, answer = p AS base, answer = f AS adv FROM q LEFT JOIN first USING (day, pri), popular),
dup AS (SELECT qa_id, row_number() OVER (PARTITION BY question ORDER BY qa_id) > 1 AS dup FROM told WHERE NOT base AND adv)
SELECT qa_id, CASE WHEN answer IS NULL THEN 'INVALID' WHEN base THEN 'TOO_EASY' WHEN NOT adv THEN 'TOO_HARD' WHEN dup THEN 'DUPLICATE' ELSE 'PASS' END AS verdict FROM told LEFT JOIN dup USING (qa_id)""")
def quality_cascade(spark, d):
    """A question for every order. The base solver knows the customer with most
    orders, the advanced one looks up the first customer by day and priority."""
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("pri"))
    o = o.join(t(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")
    asked = F.concat(F.lit("Which customer ordered on "), "day", F.lit(" at priority "), "pri", F.lit("?"))
    qa = o.select(F.concat(F.lit("order:"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("qa_id"), asked.alias("question"), F.col("c_name").alias("answer"))
    lost = t(spark, d, "region").select(F.concat(F.lit("none:"), "r_regionkey").alias("qa_id"), F.concat(F.lit("Which customer is in "), "r_name", F.lit("?")).alias("question"), F.lit(None).cast("string").alias("answer"))
    popular = o.groupBy("c_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_name").limit(1).select(F.col("c_name").alias("reply"))
    first = o.groupBy(asked.alias("question")).agg(F.min("c_name").alias("reply"))
    none = F.lit(None).cast("string").alias("error")
    base = lambda rows: rows.crossJoin(F.broadcast(popular)).select("qa_id", "reply", none)  # noqa: E731  one row on one side
    advanced = lambda rows: rows.join(first, "question", "left").select("qa_id", "reply", none)
    return quality_control.cascade(qa.unionByName(lost), base, advanced, quality_control.same_question(None)).select("qa_id", "verdict")


@query("""SELECT * FROM (VALUES ('1,500,000 people', '1.5 million people', true, true, true), ('Paris', 'It is Paris, in France.', true, true, true), ('Ann Lee and Bob Ray', 'Bob Ray', false, false, true),
  ('Lee Ann', 'Ann Lee', false, true, false), ('Rome', 'Romeo', false, false, false), ('x', '', false, false, false), ('New York', 'new-york!', true, true, true)) v(expected, given, strict, paraphrase, partial)""")
def judge_rules(spark, d):
    v = values(spark, "('1,500,000 people', '1.5 million people'), ('Paris', 'It is Paris, in France.'), ('Ann Lee and Bob Ray', 'Bob Ray'), ('Lee Ann', 'Ann Lee'), ('Rome', 'Romeo'), ('x', ''), ('New York', 'new-york!')", "expected, given")
    told = lambda mode: quality.judge(F.col("expected"), F.col("given"), F.lit(mode))
    return v.select("expected", "given", told("strict").alias("strict"), told("lenient_paraphrase").alias("paraphrase"), told("lenient_partial").alias("partial"))


INJECTED = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in escalation.OPERATIONS.items())


@query(f"""WITH op(name) AS (VALUES ('entity_merging'), ('temporal_displacement'), ('attribute_substitution'), ('condition_injection'), ('aggregation_requirement'), ('indirection')),
drawn AS (SELECT n_nationkey, n_name, name, row_number() OVER (PARTITION BY n_nationkey ORDER BY md5('inject|nation:' || n_nationkey || '|' || name), name) AS k FROM nation, op QUALIFY k <= 2)
SELECT 'nation:' || n_nationkey AS qa_id, 'Where is ' || n_name || '?' || string_agg(CASE name {INJECTED} END, '' ORDER BY k) AS question, 'Where is ' || n_name || '?,' || string_agg('uncertainty:' || name, ',' ORDER BY k) AS history FROM drawn GROUP BY n_nationkey, n_name""")
def uncertainty_injection(spark, d):
    asked = F.concat(F.lit("Where is "), "n_name", F.lit("?"))
    qa = t(spark, d, "nation").select(F.concat(F.lit("nation:"), "n_nationkey").alias("qa_id"), asked.alias("question"), F.array(asked).alias("history"))
    return escalation.inject(qa).select("qa_id", "question", F.array_join("history", ",").alias("history"))


@query("""WITH f AS (SELECT n_regionkey AS r, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos FROM nation QUALIFY pos < n_regionkey)
SELECT 'region:' || r_regionkey AS qa_id, 'What is ' || r_name || '?' || coalesce(string_agg(' Take into account: ' || n_name, '' ORDER BY pos), '') AS question,
CASE WHEN count(pos) > 0 THEN 'escalated_' || least(3, count(pos)) ELSE 'seed' END AS difficulty, count(pos)::INT AS rounds FROM region LEFT JOIN (SELECT * FROM f WHERE pos < 3) ON r = r_regionkey GROUP BY r_regionkey, r_name""")
def corpus_escalation(spark, d):
    """Region k has k facts, so the first has none and stays as it was."""
    asked = F.concat(F.lit("What is "), "r_name", F.lit("?"))
    qa = t(spark, d, "region").select(F.concat(F.lit("region:"), "r_regionkey").alias("qa_id"), asked.alias("question"), F.lit("seed").alias("difficulty"), F.array().cast("array<string>").alias("history"))
    pos = (F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1).alias("pos")
    facts = t(spark, d, "nation").select("n_regionkey", F.col("n_name").alias("fact"), pos).filter("pos < n_regionkey")
    made = escalation.corpus_rounds(qa, facts.select(F.concat(F.lit("region:"), "n_regionkey").alias("qa_id"), "pos", "fact"))
    return made.select("qa_id", "question", "difficulty", F.size("history").alias("rounds"))


@query("SELECT doc_id::VARCHAR AS qa_id, CASE WHEN quality = 1 THEN 'new' ELSE d.lang END AS question FROM documents d LEFT JOIN labels l USING (doc_id)")
def batch_fallback(spark, d):
    """Failed and missing steps keep the original."""
    original = t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("qa_id"), F.col("lang").alias("question"))
    tried = t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("qa_id"), F.lit("new").alias("question"), F.when(F.col("quality") != 1, "failed").alias("error"))
    return escalation.fallback(original, tried, ["question"])


@query()
def graph_escalation(spark, d):
    members = _regions(spark, d)
    order = F.row_number().over(Window.partitionBy("sample").orderBy("node"))
    members = members.withColumn("pos", order)
    e, r = entities(spark, d), relations(spark, d)
    qa = quality_control.graph_questions(members, e, r).withColumn("difficulty", F.lit("seed")).withColumn("history", F.array().cast("array<string>"))
    made, grown = escalation.graph_rounds(Scratch(spark, "qa").keep(qa), members, e, r, 2)
    ids = grown.groupBy("sample").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "node"))), lambda x: x["node"]), ",").alias("ids"))
    return made.join(ids, "sample").select("qa_id", "question", "difficulty", F.size("history").alias("rounds"), "ids")


@query()
def corpus_track(spark, d):
    return tracks.corpus_track(t(spark, d, "documents"))


# ---- tools --------------------------------------------------------------------------


def toolbox(spark, d) -> tools.Registry:
    docs = t(spark, d, "documents")
    corpus = docs.select(F.col("doc_id").alias("id"), F.concat(F.lit("doc "), "doc_id").alias("title"), "text", F.concat(F.lit("https://docs/"), "doc_id").alias("url"))
    names = F.array(F.struct(F.col("source").alias("name")))
    papers = docs.select(F.col("doc_id").alias("id"), F.concat(F.lit("paper "), "doc_id").alias("title"), names.alias("authors"), F.lit(2020).alias("year"), F.col("lang").alias("venue"), F.col("text").alias("abstract"), F.lit(0).alias("citation_count"), F.concat(F.lit("https://papers/"), "doc_id").alias("url"))
    articles = t(spark, d, "nation").select(F.col("n_name").alias("title"), F.lit("a nation").alias("description"), F.lit("short").alias("extract"), F.repeat("n_name", 2000).alias("body"))
    return tools.offline(corpus, papers, articles, t(spark, d, "pages"), t(spark, d, "part").withColumn("id", F.col("p_partkey")), ["p_name", "p_brand", "p_type"])


CALLS = [("1", "calculator", "2 ** 10"), ("2", "Unit_Converter", "13.6 eV to J please"), ("3", "timeline", "diff 1945-07-16, 1986-04-26"), ("4", "abacus", "1"), ("5", "python", "import os"), ("6", "comparison", "no json"), ("7", "wikipedia", "atlantis"), ("8", "table", "ftp://x | y"), ("9", "document_reader", "nowhere pages=1-2"), ("10", None, "x"), ("11", "visit", "https://nowhere | goal"), ("12", "calculator", ""), ("13", "unit_converter", "1. m to km")]


@query("""SELECT * FROM (VALUES ('1', 'calculator', '1024', NULL), ('2', 'unit_converter', '13.6 ev = 2.17896e-18 j', NULL), ('3', 'timeline', '14894 days (40 years, 9 months, 24 days)', NULL), ('4', 'abacus', NULL, 'unknown tool: abacus'),
  ('5', 'python', 'import not allowed: os', NULL), ('6', 'comparison', 'no json', NULL), ('7', 'wikipedia', 'Article not found: atlantis', NULL), ('8', 'table', NULL, NULL), ('9', 'document_reader', 'File not found: nowhere', NULL), ('10', NULL, NULL, 'unknown tool: '),
  ('11', 'visit', 'Could not read: https://nowhere', NULL), ('12', 'calculator', 'No expression provided.', NULL), ('13', 'unit_converter', '1.0 m = 0.001 km', NULL)) v(key, tool, result, error)""")
def tool_calls(spark, d):
    return toolbox(spark, d).execute(spark.createDataFrame(CALLS, "key string, tool string, query string"))


@query("""WITH d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))) AS w FROM documents), q(key, w) AS (VALUES ('a', 'the'), ('a', 'thing'), ('a', 'clown'), ('b', 'and'), ('b', 'nothinglikethis')),
h AS (SELECT key, doc_id, count(*) AS score FROM q JOIN d USING (w) GROUP BY ALL) SELECT key, row_number() OVER (PARTITION BY key ORDER BY score DESC, doc_id)::INT AS rank, doc_id AS id, score::BIGINT AS score FROM h QUALIFY rank <= 10""")
def search_many(spark, d):
    calls = values(spark, "('a', 'The thing; CLOWN the'), ('b', 'and nothinglikethis'), ('c', '?!')", "key, query")
    return tools.search(calls, t(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query("""WITH d AS (SELECT doc_id, source, lang, unnest(list_distinct(regexp_extract_all(lower('paper ' || doc_id || ' ' || text), '[\\p{L}\\p{N}]+'))) AS w FROM documents),
h AS (SELECT doc_id, source, lang, count(*) AS score FROM d WHERE w IN ('the', 'paper') GROUP BY ALL) SELECT 'a' AS key, row_number() OVER (ORDER BY score DESC, doc_id)::INT AS rank, 'paper ' || doc_id AS title, source AS authors, lang AS venue, 'https://papers/' || doc_id AS url FROM h QUALIFY rank <= 5""")
def scholar_search(spark, d):
    docs = t(spark, d, "documents")
    papers = docs.select(F.col("doc_id").alias("id"), F.concat(F.lit("paper "), "doc_id").alias("title"), F.array(F.struct(F.col("source").alias("name"))).alias("authors"), F.lit(2020).alias("year"), F.col("lang").alias("venue"), F.col("text").alias("abstract"), F.lit(0).alias("citation_count"), F.concat(F.lit("https://papers/"), "doc_id").alias("url"))
    found = tools.scholar(values(spark, "('a', 'the paper')", "key, query"), papers)
    return found.select("key", "rank", "title", F.array_join("authors", ", ").alias("authors"), "venue", "url")


@query("SELECT n_nationkey::VARCHAR AS key, '# ' || n_name || chr(10) || 'a nation' || chr(10) || chr(10) || CASE WHEN length(repeat(n_name, 2000)) > 8000 THEN substr(repeat(n_name, 2000), 1, 8000) || '...' ELSE repeat(n_name, 2000) END AS result FROM nation")
def encyclopedia(spark, d):
    calls = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.lower("n_name").alias("query"))
    return toolbox(spark, d).get("Wikipedia").run(calls)


@query("""SELECT * FROM (VALUES ('1', 'Kings ruled the north. Their kings were many.'), ('2', 'Kings ruled the north. Nothing else.' || chr(10) || 'Their kings were many.'), ('3', 'Could not read: https://b/2')) v(key, result)""")
def goal_summary(spark, d):
    ship(spark)
    pages = spark.createDataFrame([("https://a/1", "<h1></h1><p>Kings ruled the north. Nothing else.</p><p>Their kings were many.</p><script>kings</script>"), ("https://b/2", "<nav>kings</nav>")], "url string, html string")
    calls = spark.createDataFrame([("1", "https://a/1 | about kings"), ("2", "https://a/1"), ("3", "https://b/2 | kings")], "key string, query string")
    return tools.visit(calls, pages)


@query("""SELECT * FROM (VALUES ('1', 'Kings' || chr(10) || 'name | year' || chr(10) || 'Ann | 1700' || chr(10) || 'Bob | 1800'), ('2', NULL), ('3', 'Kings' || chr(10) || 'name | year' || chr(10) || 'Ann | 1700' || chr(10) || 'Bob | 1800')) v(key, result)""")
def page_tables(spark, d):
    ship(spark)
    page = "<h2>Kings</h2><table><tr><th>name<th>year</tr><tr><td>Ann<td>1700</tr><tr><td>short</tr><tr><td>Bob</td><td>1800</td></tr></table>"
    calls = spark.createDataFrame([("1", "https://a/1 | ann"), ("2", "https://a/1 | zebra"), ("3", "https://a/1")], "key string, query string")
    return tools.table(calls, spark.createDataFrame([("https://a/1", page), ("https://a/2", "")], "url string, html string"))


@query("""SELECT * FROM (VALUES ('a', '[One] kings of old' || chr(10) || '[Three] kings and crowns' || chr(10) || chr(10) || 'Kings ruled.' || chr(10) || 'name' || chr(10) || 'year' || chr(10) || 'Ann' || chr(10) || '1700' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'More on crowns.' || chr(10) || chr(10) || chr(10) || 'name | year' || chr(10) || 'Ann | 1700')) v(key, text)""")
def search_visit_chain(spark, d):
    ship(spark)
    corpus = spark.createDataFrame([(1, "One", "kings of old", "https://a/1"), (2, "Two", "kings too", ""), (3, "Three", "kings and crowns", "https://a/3"), (4, "Four", "nothing", "https://a/4")], "id int, title string, text string, url string")
    pages = spark.createDataFrame([("https://a/1", "<p>Kings ruled.</p><table><tr><th>name<th>year</tr><tr><td>Ann<td>1700</tr></table>"), ("https://a/3", "<p>More on crowns.</p>")], "url string, html string")
    return tools.search_visit(spark.createDataFrame([("a", "kings"), ("b", "zebra")], "key string, query string"), corpus, pages)


@query("""WITH r AS (SELECT p_partkey, lower(p_name || ' ' || p_brand || ' ' || p_type) AS x FROM part), s AS (SELECT p_partkey, x, CASE WHEN contains(x, 'small') THEN 1 ELSE 0 END + CASE WHEN contains(x, 'steel') THEN 1 ELSE 0 END + CASE WHEN contains(x, 'small steel') THEN 2 ELSE 0 END AS score FROM r),
k AS (SELECT x, row_number() OVER (ORDER BY score DESC, p_partkey) AS rank FROM s WHERE score > 0 QUALIFY rank <= 10)
SELECT '1' AS key, (SELECT string_agg(rank || '. ' || x, chr(10) ORDER BY rank) FROM k) AS result UNION ALL SELECT '2', NULL""")
def knowledge_base_tool(spark, d):
    return toolbox(spark, d).get("knowledge_base").run(values(spark, "('1', 'Small STEEL'), ('2', 'zzzqqq')", "key, query"))


@query("SELECT doc_id::VARCHAR AS key, CASE WHEN length(substr(text, 1, 6000)) > 4000 THEN substr(text, 1, 4000) || chr(10) || '... [truncated]' ELSE substr(text, 1, 6000) END AS result FROM documents")
def document_read(spark, d):
    docs = t(spark, d, "documents")
    calls = docs.select(F.col("doc_id").cast("string").alias("key"), F.concat(F.col("doc_id").cast("string"), F.lit(" pages=1-2")).alias("query"))
    return tools.document_reader(calls, docs.select(F.col("doc_id").cast("string").alias("path"), "text"), 4000)


@query("""SELECT * FROM (VALUES ('diff 1945-07-16, 1986-04-26', 'diff', '14894 days (40 years, 9 months, 24 days)'), ('ADD 2024-01-31, 1 months', 'add', '2024-02-28'), ('add 2024-02-29, 1 year', 'add', NULL), ('overlap 1914-1918, 1939-1945', 'overlap', 'no overlap, gap of 11323 days'),
  ('overlap 1914-1940, 1939-1945', 'overlap', 'overlap of 365 days'), ('order b: 1999; a: 1990-02-03; c: soon', 'order', '1. a: 1990-02-03' || chr(10) || '2. b: 1999'), ('huh', NULL, NULL)) v(x, operation, said)""")
def timeline_answers(spark, d):
    v = values(spark, "('diff 1945-07-16, 1986-04-26'), ('ADD 2024-01-31, 1 months'), ('add 2024-02-29, 1 year'), ('overlap 1914-1918, 1939-1945'), ('overlap 1914-1940, 1939-1945'), ('order b: 1999; a: 1990-02-03; c: soon'), ('huh')", "x")
    return v.select("x", dates.operation(F.col("x")).alias("operation"), dates.answer(F.col("x")).alias("said"))


GRID_JSON = '{"entities":["A","B"],"attributes":["size","age"],"comparison":{"A":{"size":"3"},"B":{"size":"4","age":"9"}},"summary":"B is older"}'


@query(f"""WITH g AS (SELECT rpad('Attribute', 25, ' ') || rpad('A', 25, ' ') || rpad('B', 25, ' ') AS head) SELECT 1 AS k, head || chr(10) || repeat('-', 75) || chr(10) || rpad('size', 25, ' ') || rpad('3', 25, ' ') || rpad('4', 25, ' ') || chr(10) || rpad('age', 25, ' ') || rpad('N/A', 25, ' ') || rpad('9', 25, ' ') || chr(10) || chr(10) || 'Summary: B is older' AS said FROM g
UNION ALL SELECT 2, '{{"a":1}}' UNION ALL SELECT 3, 'none at all'""")
def comparison_grid(spark, d):
    ship(spark)
    v = spark.createDataFrame([(1, f"so {GRID_JSON}"), (2, '{"a":1}'), (3, "none at all")], "k int, x string")
    return v.select("k", text.comparison_grid(F.col("x")).alias("said"))


@query("SELECT * FROM (VALUES ('import math', NULL), ('import os', 'import not allowed: os'), ('open(1)', 'call not allowed: open')) v(code, problem)")
def import_check(spark, d):
    ship(spark)
    tools.register_functions(spark)
    return spark.sql("SELECT code, import_problem(code) AS problem FROM VALUES ('import math'), ('import os'), ('open(1)') AS v(code)")


@query("""SELECT 'test' AS stage, tool, query, ok, '{"event":"tool_call","stage":"test","tool":"' || tool || '","query":"' || query || '","ok":' || ok || '}' AS event FROM (VALUES ('calculator', '1 + 1', true), ('table', 'ftp://x', false)) v(tool, query, ok)""")
def event_log(spark, d):
    calls = values(spark, "('1', 'calculator', '1 + 1'), ('2', 'table', 'ftp://x')", "key, tool, query")
    return tools.event_log(toolbox(spark, d).execute(calls), calls, "test")


@query("""SELECT * FROM (VALUES ('1', 'forty two', 2, 'calculator', '42'), ('2', NULL, 2, 'calculator', '42'), ('3', 'Paris', 1, NULL, NULL)) v(qa_id, answer, steps, tool, seen)""")
def react_trajectories(spark, d):
    """A scripted model: question 1 calls once, 2 never ends, 3 answers at once."""

    def model(talk):
        if "Paris" in talk[0]:
            return "Paris"
        if "ends" in talk[0] or len(talk) < 2:
            return "Let me see.\nTOOL_CALL: Calculator | 6 * 7"
        return "forty two"

    asked = values(spark, "('1', 'what is it?'), ('2', 'never ends'), ('3', 'Paris?')", "qa_id, question")
    got = providers.react(asked, model, {"calculator": calc.calculate}, "qa_id", "question", 2)
    first = F.try_element_at("steps", F.lit(1))
    return got.select("qa_id", "answer", F.size("steps").alias("steps"), first["tool"].alias("tool"), first["observation"].alias("seen"))


@query("SELECT * FROM (VALUES (1, '1. name: a | size: 3' || chr(10) || '2. name: b'), (2, '')) v(k, said)")
def numbered_results(spark, d):
    pair = "named_struct('key', '{0}', 'value', {1})"
    items = f"array(array({pair.format('name', chr(39) + 'a' + chr(39))}, {pair.format('size', chr(39) + '3' + chr(39))}), array({pair.format('name', chr(39) + 'b' + chr(39))}, {pair.format('size', 'CAST(NULL AS string)')}))"
    v = spark.sql(f"SELECT * FROM VALUES (1, {items}), (2, slice({items}, 1, 0)) AS v(k, x)")
    return v.select("k", text.numbered(F.col("x")).alias("said"))


@query("SELECT n_regionkey AS region, string_agg('- [' || n_name || ']: ' || n_nationkey, chr(10) ORDER BY n_nationkey) AS facts, string_agg(chr(10) || '--- Source ' || k || ' (ID: ' || n_nationkey || ') ---' || chr(10) || 'Domain: ' || n_regionkey || chr(10) || 'Entities: ' || n_name || ', x' || chr(10) || 'Content: ' || lower(n_name) || chr(10), '' ORDER BY n_nationkey) AS sources FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation) GROUP BY 1")
def fact_groups(spark, d):
    n = t(spark, d, "nation")
    chunk = F.struct(F.col("n_nationkey").alias("id"), F.col("n_regionkey").cast("string").alias("domain"), F.array("n_name", F.lit("x")).alias("entities"), F.lower("n_name").alias("summary"))
    made = n.groupBy(F.col("n_regionkey").alias("region")).agg(text.fact_group(F.col("n_name"), F.col("n_nationkey").cast("string"), F.col("n_nationkey")).alias("facts"), F.array_sort(F.collect_list(chunk)).alias("chunks"))
    return made.select("region", "facts", text.source_blocks(F.col("chunks")).alias("sources"))


@query("WITH w AS (SELECT n_nationkey, unnest(list_filter(regexp_split_to_array(lower(n_name || ' is in ' || n_regionkey), '[^a-z0-9]+'), lambda x: x <> '')) AS x FROM nation) SELECT n_nationkey, (('0x' || substr(md5(x), 1, 8))::BIGINT % 64)::INT AS place, count(*)::DOUBLE AS n FROM w GROUP BY ALL")
def text_embedding(spark, d):
    v = similarity.embed(F.concat("n_name", F.lit(" is in "), F.col("n_regionkey").cast("string")))
    return t(spark, d, "nation").select("n_nationkey", F.posexplode(v).alias("place", "n")).filter("n > 0")


@query("SELECT * FROM (VALUES (1, NULL), (2, '{\"answer\": \"b\"}'), (3, '{\"answer\": \"c\"}')) v(k, json)")
def json_rescue_fenced(spark, d):
    """Without a direct pass over the whole text: bare JSON is found by its braces."""
    rows = r"""(1, 'none'), (2, 'so:\n```json\n{"answer": "b"}\n``` {"answer": "z"}'), (3, '{"answer": "c"}')"""
    return values(spark, rows, "k, x").select("k", text.json_rescue(F.col("x"), "answer", whole_first=False).alias("json"))


@query(r"SELECT doc_id, CASE WHEN length(text) > 2000 THEN substr(text, 1, 2000) || '...' ELSE text END AS cut, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 20 AS long_enough FROM documents")
def truncations(spark, d):
    return t(spark, d, "documents").select("doc_id", text.truncated(F.col("text"), 2000).alias("cut"), (F.length(text.strip(F.col("text"))) >= 20).alias("long_enough"))


@query("SELECT * FROM (VALUES ('- calculator: works out an expression')) v(line)")
def tool_enablement(spark, d):
    ship(spark)
    lines = toolbox(spark, d).enabled(["calculator", "nothing"]).descriptions().splitlines()
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query(f"WITH {JUDGED}, k AS (SELECT doc_id // 50 AS batch, doc_id, verdict, row_number() OVER (PARTITION BY doc_id // 50 ORDER BY doc_id) AS i FROM j) SELECT batch, doc_id, row_number() OVER (PARTITION BY batch ORDER BY doc_id)::INT AS place FROM k WHERE i <= 15 AND verdict = 'PASS' QUALIFY place <= 5")
def first_n_with_retries(spark, d):
    """Twice as many are started as wanted, and as many tried again if too few pass."""
    rows = _judged(spark, d).withColumn("batch", F.expr("doc_id div 50"))
    rows = rows.withColumn("i", F.row_number().over(Window.partitionBy("batch").orderBy("doc_id"))).filter("i <= 15")
    return sampling.first_n(rows, 5, "doc_id", ["batch"], F.col("verdict") == "PASS").select("batch", "doc_id", "place")


# ---- sources and sinks, each written to the shared folder and read back -------------


def _folder(spark, name: str) -> str:
    return Scratch(spark, name).base


@query("SELECT r_regionkey::VARCHAR || ' ' || r_name AS text FROM region WHERE r_regionkey > 0")
def corpus_files(spark, d):
    folder = _folder(spark, "corpus")
    r = t(spark, d, "region")
    said = F.when(F.col("r_regionkey") > 0, F.concat(F.lit("\n  "), F.col("r_regionkey").cast("string"), F.lit(" "), "r_name", F.lit(" \n\t"))).otherwise(F.lit(" \n "))
    r.select(said.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return files.corpus(spark, folder).select("text")


@query("SELECT doc_id::VARCHAR AS id, text AS question, lang AS domain FROM documents UNION ALL SELECT 'again' || doc_id, text, lang FROM documents JOIN labels USING (doc_id)")
def jsonl_round_trip(spark, d):
    folder = _folder(spark, "jsonl")
    docs = t(spark, d, "documents")
    qa = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("question"), F.col("lang").alias("domain"))
    files.save_jsonl(qa, f"{folder}/qa")
    more = docs.join(t(spark, d, "labels").select("doc_id"), "doc_id").select(F.concat(F.lit("again"), "doc_id").alias("id"), F.col("text").alias("question"), F.col("lang").alias("domain"))
    none = more.select(F.lit(None).cast("string").alias("trajectory"))
    files.append_pair(more, none, folder)
    return files.jsonl(spark, f"{folder}/qa").filter("_bad is null").select("id", "question", "domain")


@query("SELECT * FROM (VALUES ('a', 'q1', false), (NULL, NULL, true)) v(id, question, bad)")
def jsonl_bad_lines(spark, d):
    folder = _folder(spark, "lines")
    values(spark, "('{\"id\": \"a\", \"question\": \"q1\"}'), (''), ('{broken')", "value").coalesce(1).write.text(folder)
    return files.jsonl(spark, folder).select("id", "question", F.col("_bad").isNotNull().alias("bad")).filter("id is not null or bad")


@query(f"WITH {ENT} SELECT id, name, seq::BIGINT AS seq, 'located' AS section FROM (SELECT id, name, row_number() OVER (ORDER BY id) - 1 AS seq FROM ent WHERE entity_type = 'region') UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, row_number() OVER (ORDER BY n_nationkey) - 1, 'relation' FROM nation")
def graph_file(spark, d):
    folder = _folder(spark, "graph")
    e = t(spark, d, "region").select(F.concat(F.lit("region:"), "r_regionkey").alias("id"), F.col("r_name").alias("name"))
    r = t(spark, d, "nation").select("n_nationkey", F.concat(F.lit("nation:"), "n_nationkey").alias("source_id"), F.concat(F.lit("region:"), "n_regionkey").alias("target_id"))
    nodes = e.agg(F.array_sort(F.collect_list(F.struct("id", "name"))).alias("entities"))
    links = r.agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "source_id", "target_id"))), lambda x: F.struct(x["source_id"].alias("source_id"), x["target_id"].alias("target_id"))).alias("relations"))
    nodes.crossJoin(links).select(F.to_json(F.struct("entities", "relations")).alias("value")).coalesce(1).write.text(folder)  # one row each
    made, edges = files.graph(spark, folder)
    return made.select("id", "name", "seq", F.lit("located").alias("section")).unionByName(edges.select(F.col("source_id").alias("id"), F.col("target_id").alias("name"), F.col("edge_seq").alias("seq"), F.lit("relation").alias("section")))


@query("SELECT n_name AS name, 'list' AS category FROM nation UNION ALL SELECT r_name, 'regions' FROM region UNION ALL SELECT n_name || 'c', 'csv' FROM nation")
def knowledge_base_files(spark, d):
    folder = _folder(spark, "kb")
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    n.agg(F.to_json(F.collect_list(F.struct(F.col("n_name").alias("name")))).alias("value")).write.text(f"{folder}/a")
    r.agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("r_name").alias("name"))).alias("regions"), F.lit(7).alias("other"))).alias("value")).write.text(f"{folder}/b/c")
    values(spark, "('{broken')", "value").coalesce(1).write.text(f"{folder}/d")
    n.select(F.concat("n_name", F.lit("c")).alias("name"), F.lit('a "b", c').alias("note")).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/e")
    for part, kind in (("a", "json"), ("b/c", "json"), ("d", "json"), ("e", "csv")):
        _rename(spark, f"{folder}/{part}", kind)
    kb = files.knowledge_base(spark, folder)
    return kb.select(F.col("record")["name"].alias("name"), F.coalesce("_category", F.when(F.col("_source_file").endswith(".csv"), "csv").otherwise("list")).alias("category"))


def _rename(spark, folder: str, kind: str) -> None:
    """Give a folder's part files an ending."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k, f in enumerate(x for x in fs.listStatus(path(folder)) if x.getPath().getName().startswith("part-")):
        fs.rename(f.getPath(), path(f"{folder}/{k}.{kind}"))


@query("SELECT doc_id, 1 AS made FROM documents")
def stage_checkpoint(spark, d):
    """The second asking reads what the first one wrote."""
    folder, made = _folder(spark, "stages"), []

    def rows():
        made.append(1)
        return t(spark, d, "documents").select("doc_id")

    files.stage(spark, rows, folder, "docs")
    return files.stage(spark, rows, folder, "docs").withColumn("made", F.lit(len(made)))


@query(f"WITH {ENT}, {REL} SELECT 'entity' AS section, id, NULL AS target FROM ent WHERE entity_type <> 'part' UNION ALL SELECT 'relation', s, t FROM rel WHERE k <> 'supplied_by' UNION ALL SELECT 'qa', doc_id::VARCHAR, coalesce(l.quality::VARCHAR, d.source) FROM documents d LEFT JOIN labels l USING (doc_id)")
def sample_bundle(spark, d):
    """A bundle with the whole graph, its graph replaced by the one without parts."""
    folder = _folder(spark, "bundle")
    e, r = entities(spark, d), relations(spark, d)
    files.save_bundle(e, r, subgraph_ids(spark, d), folder)
    files.replace_graph(e.filter("entity_type <> 'part'"), r.filter("relation_type <> 'supplied_by'"), folder)
    read = lambda part, schema: spark.read.schema(schema).json(f"{folder}/{part}")
    made = read("knowledge_graph/entities", "id string").select(F.lit("entity").alias("section"), "id", F.lit(None).cast("string").alias("target"))
    made = made.unionByName(read("knowledge_graph/relations", "source_id string, target_id string").select(F.lit("relation").alias("section"), F.col("source_id").alias("id"), F.col("target_id").alias("target")))
    return made.unionByName(read("qa_pairs", "doc_id string, subgraph string").select(F.lit("qa").alias("section"), F.col("doc_id").alias("id"), F.col("subgraph").alias("target")))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, d):
    folder = _folder(spark, "seen")
    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    t(spark, d, "events").write.parquet(f"{folder}/in")
    stream = events.first_seen(spark.readStream.schema(schema).parquet(f"{folder}/in"), ["user_id", "event_type"], late="60 days").select("user_id", "event_type")
    q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("user_id bigint, event_type string").parquet(f"{folder}/out")


@query(ORACLES["greedy_dedup"])
def stream_greedy_index(spark, d):
    """The embeddings as one batch of a stream into an index; a replay adds nothing."""
    folder = _folder(spark, "index")
    t(spark, d, "embeddings").select("vec_id", "embedding").write.parquet(f"{folder}/in")
    into = events.greedy_into(f"{folder}/index", "vec_id", "embedding", 0.3)
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).parquet(f"{folder}/in")
    q = stream.writeStream.foreachBatch(into).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    into(spark.read.parquet(f"{folder}/in"), 0)
    return spark.read.schema("vec_id bigint").parquet(f"{folder}/index").select(F.col("vec_id").alias("id"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """A graph's sampled questions with their verdicts."""
    return graph_track(spark, d)
