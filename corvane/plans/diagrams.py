"""Queries over the diagram documents of training records."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import diagrams as D
from corvane.plans.catalog import query, table
from corvane.skew import lookup_join
from corvane.workspace import Workspace

DOCS = "docs AS (SELECT id, diagram_ir AS j FROM training_records WHERE json_valid(diagram_ir) AND json_type(diagram_ir,'$.nodes') = 'ARRAY')"
NODES = """nodes AS (SELECT id, pos-1 AS pos, n->>'$.id' AS node_id, n->>'$.kind' AS kind, coalesce(n->>'$.label','') AS label, CAST(n->>'$.size_hint.min_width' AS DOUBLE) AS min_width, CAST(n->>'$.size_hint.min_height' AS DOUBLE) AS min_height
 FROM (SELECT id, unnest(x) AS n, generate_subscripts(x,1) AS pos FROM (SELECT id, json_extract(j,'$.nodes[*]') AS x FROM docs)))"""
EDGES = """edges AS (SELECT id, pos-1 AS pos, n->>'$.id' AS edge_id, n->>'$.source' AS source, n->>'$.target' AS target, coalesce(n->>'$.label','') AS label
 FROM (SELECT id, unnest(x) AS n, generate_subscripts(x,1) AS pos FROM (SELECT id, json_extract(j,'$.edges[*]') AS x FROM docs)))"""
MEASURED = """measured AS (SELECT *, greatest(coalesce(min_width,0), ceil(list_max(list_transform(string_split(CASE WHEN label='' THEN node_id ELSE label END, chr(10)), lambda s: length(s)))*7.199999999999999::DOUBLE+32)) AS width,
 greatest(coalesce(min_height,0), ceil(len(string_split(CASE WHEN label='' THEN node_id ELSE label END, chr(10)))*18.0+24)) AS height FROM nodes)"""
LAYOUT = """canvas AS (SELECT id, CAST(j->>'$.canvas.width' AS DOUBLE) AS canvas_width FROM docs),
 spaced AS (SELECT m.*, CASE WHEN count(*) OVER (PARTITION BY m.id) > 1 THEN least(48.0::DOUBLE, greatest(24.0::DOUBLE, (greatest(1.0::DOUBLE, canvas_width-64) - sum(width) OVER (PARTITION BY m.id)) / greatest(count(*) OVER (PARTITION BY m.id)-1,1))) ELSE 48.0::DOUBLE END AS spacing FROM measured m JOIN canvas USING (id)),
 boxes AS (SELECT id, pos, node_id, 32.0::DOUBLE + coalesce(sum(width+spacing) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x, 32.0::DOUBLE AS y, width, height FROM spaced)"""


def _docs(spark, sf_dir):
    return D.documents(table(spark, sf_dir, "training_records"))


def _laid(spark, sf_dir):
    return D.row_layout(_docs(spark, sf_dir))


@query(f"WITH {DOCS}, {NODES} SELECT kind, count(*) AS n, count(DISTINCT label) AS labels, round(avg(min_width),6) AS avg_width FROM nodes GROUP BY kind")
def node_kinds(spark, sf_dir):
    nodes = D.nodes(_docs(spark, sf_dir))
    per = nodes.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("min_width").alias("w"), F.count("min_width").alias("c"))
    return per.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"), F.round(F.sum("w") / F.sum("c"), 6).alias("avg_width"))


ENDS = """groups AS (SELECT id, g->>'$.id' AS part_id, unnest(CAST(json_extract_string(g, '$.members[*]') AS VARCHAR[])) AS node_id FROM (SELECT id, unnest(json_extract(j,'$.groups[*]')) AS g FROM docs)),
 ends AS (SELECT id, 'edge' AS part, edge_id AS part_id, 'source' AS role, source AS node_id FROM edges UNION ALL SELECT id, 'edge', edge_id, 'target', target FROM edges UNION ALL SELECT id, 'group', part_id, 'member', node_id FROM groups)"""


@query(f"""WITH {DOCS}, {NODES}, {EDGES}, {ENDS} SELECT id, part, part_id, role, node_id FROM ends e WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.id=e.id AND n.node_id=e.node_id)""")
def ref_integrity(spark, sf_dir):
    """Edge ends and group members that name no node."""
    return D.dangling(_docs(spark, sf_dir))


@query(f"""WITH {DOCS}, {NODES}, {EDGES}, {ENDS} SELECT id, part, part_id, role, node_id FROM ends e WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.id=e.id AND n.node_id=e.node_id AND n.pos>0)""")
def ref_integrity_broken(spark, sf_dir):
    """The same once every document has lost its first node, so that there is something to find."""
    docs = _docs(spark, sf_dir).filter(F.size("doc.nodes") > 0)
    return D.dangling(docs.withColumn("doc", F.col("doc").withField("nodes", F.slice("doc.nodes", 2, F.size("doc.nodes")))))


@query(f"""WITH {DOCS}, {NODES}, want AS (SELECT t.id, unnest(regexp_extract_all(t.prompt,'"([^"]+)"',1)) AS label FROM training_records t JOIN docs USING (id)), own AS (SELECT DISTINCT id, label FROM nodes),
 j AS (SELECT w.id, w.label, o.label IS NOT NULL AS hit FROM want w LEFT JOIN own o ON w.id=o.id AND w.label=o.label)
 SELECT d.id, count(j.label) AS expected, count(*) FILTER (WHERE NOT hit) AS missing, round(CASE WHEN count(j.label)=0 THEN 1.0 ELSE count(*) FILTER (WHERE hit)::DOUBLE/count(j.label) END,6) AS recall FROM docs d LEFT JOIN j ON d.id=j.id GROUP BY d.id""")
def label_recall(spark, sf_dir):
    """Labels quoted in the prompt that the document has; nothing expected counts as recalled."""
    records = table(spark, sf_dir, "training_records")
    rows = D.documents(records.select(F.struct("id", "prompt").alias("id"), "diagram_ir")).select("id.*", F.col("doc.nodes.label").alias("labels"))
    expected = F.coalesce(F.regexp_extract_all("prompt", F.lit('"([^"]+)"'), F.lit(1)), F.array().cast("array<string>"))
    missing = F.size(F.filter(expected, lambda x: ~F.coalesce(F.array_contains(F.transform("labels", lambda y: F.coalesce(y, F.lit(""))), x), F.lit(False))))
    recall = F.when(F.size(expected) == 0, 1.0).otherwise((F.size(expected) - missing) / F.size(expected))
    return rows.select("id", F.size(expected).cast("long").alias("expected"), missing.cast("long").alias("missing"), F.round(recall, 6).alias("recall"))


LABELLED = """named AS (SELECT id, node_id, arg_max(label,pos) AS label FROM nodes GROUP BY id, node_id),
 le AS (SELECT e.id, coalesce(s.label, e.source) AS source_label, coalesce(t.label, e.target) AS target_label FROM edges e LEFT JOIN named s ON s.id=e.id AND s.node_id=e.source LEFT JOIN named t ON t.id=e.id AND t.node_id=e.target)"""


@query(f"""WITH {DOCS}, {NODES}, {EDGES}, {LABELLED}, f AS (SELECT j->>'$.title' AS title, min(id) AS first_id FROM docs GROUP BY 1 HAVING count(*)>1), pair AS (SELECT d.id, f.first_id FROM docs d JOIN f ON d.j->>'$.title'=f.title WHERE d.id<>f.first_id),
 ex AS (SELECT p.id, l.source_label, l.target_label FROM pair p JOIN le l ON l.id=p.first_id), own AS (SELECT DISTINCT id, source_label, target_label FROM le)
 SELECT ex.id, count(*) AS expected, count(*) FILTER (WHERE o.id IS NULL) AS missing FROM ex LEFT JOIN own o ON o.id=ex.id AND o.source_label=ex.source_label AND o.target_label=ex.target_label GROUP BY ex.id""")
def edge_recall(spark, sf_dir):
    """Edges, by the labels of their ends, that a document lacks of the first one with its title."""
    titled = _docs(spark, sf_dir).select("id", F.col("doc.title").alias("title"), D.edge_labels().alias("own"))
    firsts = titled.groupBy("title").agg(F.min(F.struct("id", "own")).alias("f"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1 AND title IS NOT NULL")
    firsts = Workspace(spark, "titles").save(firsts.select("title", F.col("f.id").alias("first_id"), F.col("f.own").alias("expected"), "n_rows"), "firsts")
    total = firsts.agg(F.sum("n_rows")).first()[0] or 0
    met = lookup_join(titled, firsts.drop("n_rows"), ["title"], firsts.select("title", "n_rows"), total).filter("id <> first_id AND size(expected) > 0")
    return met.select("id", F.size("expected").cast("long").alias("expected"), D.missing_edges(F.col("expected"), F.col("own")).cast("long").alias("missing"))


@query(f"""WITH {DOCS}, {NODES}, {EDGES}, m AS (SELECT id, node_id, min(pos) OVER (PARTITION BY id, lower(kind)) AS c FROM nodes), mp AS (SELECT DISTINCT id, node_id, 's' || lpad(CAST(c+1 AS VARCHAR),3,'0') AS canonical FROM m),
 p AS (SELECT e.id, s.canonical AS f, t.canonical AS t, min(pos) AS pos FROM edges e JOIN mp s ON s.id=e.id AND s.node_id=e.source JOIN mp t ON t.id=e.id AND t.node_id=e.target WHERE s.canonical<>t.canonical GROUP BY ALL),
 k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM p) SELECT id, 'e' || lpad(CAST(k AS VARCHAR),3,'0') AS edge_id, f AS "from", t AS "to" FROM k WHERE k<=240""")
def canonical_edges(spark, sf_dir):
    """Edges between clusters of nodes of one kind."""
    first = lambda n: F.array_position(F.transform("doc.nodes", lambda m: F.coalesce(F.lower(m["kind"]), F.lit("\0"))), F.coalesce(F.lower(n["kind"]), F.lit("\0")))
    names = F.transform("doc.nodes", lambda n: F.struct(n["id"].alias("node_id"), F.concat(F.lit("s"), F.lpad(first(n).cast("string"), 3, "0")).alias("name")))
    return D.canonical_edges(_docs(spark, sf_dir), names)


@query(f"WITH {DOCS}, {NODES}, {MEASURED}, {LAYOUT} SELECT id, pos, node_id, round(x,4) AS x, y, width, height FROM boxes")
def running_layout(spark, sf_dir):
    boxes = D.boxes(_laid(spark, sf_dir))
    return boxes.select("id", F.col("pos").cast("long").alias("pos"), "node_id", F.round("x", 4).alias("x"), "y", "width", "height")


_GROUPED = "members AS (SELECT id, node_id, kind AS group_id FROM nodes)"
_FRAMES = "frames AS (SELECT id, group_id, min(x)-24 AS x, min(y)-24 AS y, max(x+width)-min(x)+48 AS width, max(y+height)-min(y)+48 AS height FROM members JOIN boxes USING (id,node_id) GROUP BY id, group_id)"


def _framed(spark, sf_dir):
    kinds = F.array_distinct(F.transform("doc.nodes", lambda n: n["kind"]))
    of_kind = lambda kind: F.transform(F.filter("doc.nodes", lambda n: n["kind"].eqNullSafe(kind)), lambda n: n["id"])
    return D.framed(_laid(spark, sf_dir), kinds, of_kind)


@query(f"WITH {DOCS}, {NODES}, {MEASURED}, {LAYOUT}, {_GROUPED}, {_FRAMES} SELECT id, group_id, round(x,4) AS x, y, round(width,4) AS width, height FROM frames")
def group_frame(spark, sf_dir):
    """Frames around the nodes of one kind."""
    return D.frames(_framed(spark, sf_dir)).select("id", "group_id", F.round("x", 4).alias("x"), "y", F.round("width", 4).alias("width"), "height")


@query(f"""WITH {DOCS}, {NODES}, {MEASURED}, {LAYOUT}, {_GROUPED}, {_FRAMES} SELECT b.id, f.group_id, b.node_id FROM boxes b JOIN frames f ON b.id=f.id AND b.x>=f.x AND b.y>=f.y AND b.x+b.width<=f.x+f.width AND b.y+b.height<=f.y+f.height""")
def containment_join(spark, sf_dir):
    return D.contained(_framed(spark, sf_dir))


@query(f"""WITH {DOCS}, {NODES}, {EDGES}, {MEASURED}, {LAYOUT}, one AS (SELECT id, node_id, min(pos) AS pos FROM boxes GROUP BY ALL), ub AS (SELECT b.* FROM boxes b JOIN one USING (id,node_id,pos)),
 pts AS (SELECT e.id, e.pos AS point_id, (s.x+s.width+t.x)/2 AS px, s.y+s.height+7 AS py FROM edges e JOIN ub s ON s.id=e.id AND s.node_id=e.source JOIN ub t ON t.id=e.id AND t.node_id=e.target),
 m AS (SELECT p.id, p.point_id, b.node_id, b.pos, round(sqrt(greatest(b.x-px,0,px-b.x-b.width)**2 + greatest(b.y-py,0,py-b.y-b.height)**2),6) AS d,
  round(abs(px-b.x),6) AS l, round(abs(px-b.x-b.width),6) AS r, round(abs(py-b.y),6) AS t, round(abs(py-b.y-b.height),6) AS o FROM pts p JOIN ub b ON b.id=p.id),
 k AS (SELECT *, row_number() OVER (PARTITION BY id, point_id ORDER BY d, pos) AS k FROM m)
 SELECT id, point_id, node_id, CASE least(l,r,t,o) WHEN l THEN 'left' WHEN r THEN 'right' WHEN t THEN 'top' ELSE 'bottom' END AS side FROM k WHERE k=1""")
def nearest_node(spark, sf_dir):
    """The node nearest to a point between the ends of each edge, and its nearest side."""
    return D.nearest(_laid(spark, sf_dir), D.edge_points()).select("id", F.col("point_id").cast("long").alias("point_id"), "node_id", "side")


@query(f"""WITH {DOCS}, {NODES}, {MEASURED}, {LAYOUT}, g AS (SELECT *, lead(x) OVER w AS nx FROM boxes WINDOW w AS (PARTITION BY id ORDER BY pos))
 SELECT id, 'horizontal' AS direction, greatest(1.0::DOUBLE, round_even(CASE WHEN count(*)<2 THEN 48.0 ELSE coalesce(median(CASE WHEN nx>=x THEN nx-x-width END),48.0) END, 0)) AS spacing FROM g GROUP BY id""")
def median_gap_layout(spark, sf_dir):
    return D.median_gaps(_laid(spark, sf_dir))


@query(f"""WITH {DOCS}, {NODES} SELECT id, string_agg(label, ' | ' ORDER BY kind, pos) FILTER (WHERE label<>'') AS labels FROM nodes GROUP BY id HAVING count(*) FILTER (WHERE label<>'')>0""")
def label_lists(spark, sf_dir):
    return D.joined_labels(_docs(spark, sf_dir)).filter("labels <> ''")
