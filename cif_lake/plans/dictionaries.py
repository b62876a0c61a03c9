"""Dictionary compile jobs over sources that Spark derives from the supplier table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cif_lake.plans import corpus
from cif_lake.plans.registry import query
from cif_lake.sources import dictionary as d
from cif_lake.sources import write

# k: supplier; src/ext: its sources; t: type of its id; p: linked parent.
B = """WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS n, s_name, s_nationkey, 'base' || (s_suppkey // 16) || '.dic' AS src, 'ext' || (s_suppkey // 16) || '.dic' AS ext,
  (['bigint','double','string'])[1 + s_suppkey % 3] AS t, CASE s_suppkey % 4 WHEN 0 THEN '_entry.id' WHEN 2 THEN '_c' || (s_suppkey // 4) || '.id' WHEN 3 THEN '_absent.id' END AS p FROM supplier),
f AS (SELECT DISTINCT src, ext, regexp_extract(src, '[0-9]+') AS num FROM s) """


def frames(spark, sf, conflicts=False):
    return d.dict_frames(corpus.dics(spark, sf, conflicts))


def merged(spark, sf):
    src = corpus.dics(spark, sf)
    return d.dict_merge(d.dict_item_types(d.dict_frames(src)), corpus.dic_sources(src))


@query(
    B + """SELECT src AS source, '' AS frame, '_dictionary.version' AS tag, '1.' || num AS value FROM f UNION ALL SELECT ext, '', '_dictionary.version', '1.' || num FROM f
    UNION ALL SELECT src, x.* FROM f, (VALUES ('entry', '_category.id', 'entry'), ('entry', '_category_key.name', '_entry.id'), ('_entry.id', '_item.name', '_entry.id'), ('_entry.id', '_item_type.code', 'code')) x(a, b, c)
    UNION ALL SELECT src, 'c' || n, '_category.id', 'c' || n FROM s
    UNION ALL SELECT src, 'c' || n, '_category.description', ' ' || s_name || chr(10) || chr(9) || 'of the lake ' FROM s
    UNION ALL SELECT src, 'c' || n, '_category.mandatory_code', (['yes','no','conditional'])[1 + k % 3] FROM s
    UNION ALL SELECT src, 'c' || n, '_category_key.name', '_c' || n || '.id' FROM s
    UNION ALL SELECT src, 'c' || n, '_category_group.id', g FROM (SELECT *, unnest(['z_group', 'g' || s_nationkey, 'z_group']) AS g FROM s)
    UNION ALL SELECT src, '_c' || n || '.id', '_item.name', '_c' || n || '.id' FROM s
    UNION ALL SELECT src, '_c' || n || '.id', '_item_type.code', (['int','float','line'])[1 + k % 3] FROM s
    UNION ALL SELECT src, '_c' || n || '.id', '_item_linked.child_name', '_c' || n || i FROM s, (VALUES ('.id'), ('.other')) v(i) WHERE p IS NOT NULL
    UNION ALL SELECT src, '_c' || n || '.id', '_item_linked.parent_name', CASE i WHEN 0 THEN p ELSE '?' END FROM s, (VALUES (0), (1)) v(i) WHERE p IS NOT NULL
    UNION ALL SELECT src, '_c' || n || '.acctbal', '_item.name', '_c' || n || '.acctbal' FROM s
    UNION ALL SELECT src, '_c' || n || '.acctbal', '_item_type.code', 'float' FROM s
    UNION ALL SELECT src, '_c' || n || '.acctbal', '_pdbx_item_type.code', 'int-range' FROM s WHERE k % 5 = 0
    UNION ALL SELECT ext, '_C' || n || '.ID', '_item_type.code', (['positive_int','float','line'])[1 + k % 3] FROM s"""
)
def dict_frames(spark, sf):
    return frames(spark, sf).select("source", "frame", "tag", "value")


@query(
    B + """SELECT src AS source, '_entry.id' AS item, 'string' AS dtype FROM f UNION ALL SELECT src, '_c' || n || '.id', t FROM s
    UNION ALL SELECT src, '_c' || n || '.acctbal', CASE WHEN k % 5 = 0 THEN 'string' ELSE 'double' END FROM s UNION ALL SELECT ext, '_C' || n || '.ID', t FROM s"""
)
def dict_item_types(spark, sf):
    return d.dict_item_types(frames(spark, sf))


@query(B + "SELECT src AS source, p AS parent, '_c' || n || '.id' AS child FROM s WHERE p IS NOT NULL")
def dict_relationships(spark, sf):
    return d.dict_relationships(frames(spark, sf))


@query(B + "SELECT src AS source, 'c' || n AS key, 'c' || n AS category FROM s UNION ALL SELECT src, 'entry', 'entry' FROM f")
def dict_categories(spark, sf):
    return d.dict_categories(frames(spark, sf))


@query(B + "SELECT src AS source, '1.' || num AS version FROM f UNION ALL SELECT ext, '1.' || num FROM f")
def dict_versions(spark, sf):
    return d.dict_versions(frames(spark, sf))


@query(
    B + """SELECT '_entry.id' AS item, 'string' AS dtype, 'https://example.org/base0.dic' AS url, 'base0.dic' AS source UNION ALL SELECT '_c' || n || '.id', t, 'https://example.org/' || src, src FROM s
    UNION ALL SELECT '_c' || n || '.acctbal', CASE WHEN k % 5 = 0 THEN 'string' ELSE 'double' END, 'https://example.org/' || src, src FROM s"""
)
def dict_merge(spark, sf):
    return merged(spark, sf)


@query(
    B + """SELECT '_c' || n || '.id' AS key, CASE WHEN k % 14 = 0 THEN 'resolved' WHEN k % 21 = 0 THEN 'invalid' ELSE 'unresolved' END AS status FROM s WHERE k % 7 = 0
    UNION ALL SELECT '_region' || r_regionkey || '.x', 'stale' FROM region"""
)
def dict_conflicts(spark, sf):
    """Type conflicts against reviewed resolutions: some fit, some name a wrong source, some are for nothing."""
    items = d.dict_item_types(frames(spark, sf, conflicts=True))
    s = corpus.table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    number = F.floor(k / corpus.PER_DIC).cast("string")
    base, ext = F.concat(F.lit("base"), number, F.lit(".dic")), F.concat(F.lit("ext"), number, F.lit(".dic"))
    dtype = lambda n: corpus.pick(n, "bigint", "double", "string")
    reviewed = s.filter((k % 14 == 0) | (k % 21 == 0)).select(
        F.concat(F.lit("_c"), k.cast("string"), F.lit(".id")).alias("key"),
        F.create_map(base, dtype(k), ext, dtype(k + 1)).alias("types"),
        F.when(k % 14 == 0, base).otherwise("nowhere.dic").alias("use"),
    )
    stale = corpus.table(spark, sf, "region").select(
        F.concat(F.lit("_region"), F.col("r_regionkey").cast("string"), F.lit(".x")).alias("key"),
        F.create_map(F.lit("a.dic"), F.lit("double")).alias("types"),
        F.lit("a.dic").alias("use"),
    )
    return d.dict_conflicts(items, reviewed.unionAll(stale)).select("key", "status")


@query(
    B + """SELECT p AS parent, '_c' || n || '.id' AS child FROM s WHERE p IS NOT NULL"""
)
def dict_canonical_links(spark, sf):
    """Link ends in the spelling of the dictionary, whatever case the sources use."""
    links = d.dict_relationships(frames(spark, sf))
    shouted = links.unionAll(links.select("source", F.upper("parent"), F.upper("child")))
    return d.dict_canonical_links(shouted, merged(spark, sf))


_META = """m AS (SELECT src AS source, 'c' || n AS category, '_c' || n || '.id' AS keys, s_name || chr(10) || chr(9) || 'of the lake' AS description,
    CASE WHEN 'g' || s_nationkey < 'z_group' THEN 'g' || s_nationkey || ',z_group' END AS groups, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_mandatory FROM s
    UNION ALL SELECT src, 'entry', '_entry.id', NULL, NULL, NULL FROM f)"""


@query(B + f", {_META} SELECT * FROM m")
def dict_category_metadata(spark, sf):
    return d.dict_category_metadata(frames(spark, sf)).withColumn("keys", F.array_join("keys", ",")).withColumn(
        "groups", F.array_join("groups", ",")
    )


_LIMITS = """WITH RECURSIVE up(k, a) AS (SELECT s_suppkey, s_suppkey FROM supplier UNION ALL SELECT k, a // 4 FROM up WHERE a % 4 = 2),
    lim AS (SELECT 'c' || k AS category, CASE arg_max(a % 4, -a) WHEN 0 THEN true WHEN 1 THEN false END AS is_single_row FROM up GROUP BY k UNION ALL SELECT 'entry', true)"""


def limits(spark, sf):
    found = frames(spark, sf).persist()
    first = d.dict_category_metadata(found).groupBy("category").agg(F.first("keys").alias("keys"))
    return d.dict_row_constraints(first, d.dict_parents(found), d.dict_item_names(found))


@query(_LIMITS + " SELECT * FROM lim")
def dict_row_constraints(spark, sf):
    """Row limits proved from keys and links, to the fixpoint."""
    return limits(spark, sf)


@query(
    B + """SELECT 'c' || n AS category, x.* FROM s, LATERAL (VALUES ('category', 'c' || n), ('description', s_name || '\\n\\tof the lake'), ('key', '_c' || n || '.id'),
    ('group', 'z_group'), ('group', 'g' || s_nationkey)) x(field, value)
    UNION ALL SELECT 'c' || n, 'is_mandatory', CASE k % 3 WHEN 0 THEN 'true' ELSE 'false' END FROM s WHERE k % 3 <> 2"""
)
def dict_long_rows(spark, sf):
    """Metadata as escaped long rows; the wide form comes back from them and goes long again."""
    meta = d.dict_category_metadata(frames(spark, sf)).filter(F.col("category") != "entry")
    meta = meta.withColumn("is_single_row", F.lit(None).cast("boolean"))
    return d.dict_long_rows(d.dict_from_long_rows(d.dict_long_rows(meta)))


@query(
    B + """SELECT '_entry.id' AS item, 'string' AS dtype, 'https://example.org/base0.dic' AS url UNION ALL SELECT '_c' || n || '.id', t, 'https://example.org/' || src FROM s
    UNION ALL SELECT '_c' || n || '.acctbal', CASE WHEN k % 5 = 0 THEN 'string' ELSE 'double' END, 'https://example.org/' || src FROM s"""
)
def dict_artifacts(spark, sf):
    """Sorted artifacts written and loaded again."""
    found = frames(spark, sf)
    meta = d.dict_category_metadata(found).filter(F.col("category") != "entry")
    meta = meta.withColumn("is_single_row", F.lit(None).cast("boolean")).withColumn("url", F.concat(F.lit("https://example.org/"), "source"))
    compiled = d.Dictionary(merged(spark, sf).drop("source"), meta, d.dict_relationships(found))
    folder = write.work_folder(spark)
    d.write_artifacts(compiled, folder)
    return d.read_artifacts(spark, folder).items


@query(B + "SELECT src AS source, true AS ok FROM f UNION ALL SELECT ext, true FROM f")
def dict_verify(spark, sf):
    """Checksums and versions of all sources against a manifest written beforehand."""
    src = corpus.dics(spark, sf)
    folder = write.work_folder(spark)
    versions = d.dict_versions(d.dict_frames(src))
    sums = src.select(F.col("path").alias("source"), F.sha2(F.col("content").cast("binary"), 256).alias("sha256"))
    sums.join(versions, "source").write.parquet(folder)
    return d.dict_verify(src, spark.read.parquet(folder), versions).select("source", "ok")


@query(B + """SELECT k, CASE i WHEN 'ID' THEN t WHEN 'AcctBal' THEN (CASE WHEN k % 5 = 0 THEN 'string' ELSE 'double' END) ELSE 'string' END AS dtype, i AS item
    FROM s, (VALUES ('ID'), ('AcctBal'), ('unknown')) v(i)""")
def type_lookup(spark, sf):
    s = corpus.table(spark, sf, "supplier")
    items = F.explode(F.array(F.lit("ID"), F.lit("AcctBal"), F.lit("unknown")))
    names = s.select(F.col("s_suppkey").alias("k"), F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("category"), items.alias("item"))
    return d.with_types(names, _compiled(spark, sf)).select("k", "item", "dtype")


def _compiled(spark, sf):
    src = corpus.dics(spark, sf)
    found = d.dict_frames(src)
    cats = d.dict_merge_categories(d.dict_categories(found), corpus.dic_sources(src))
    return d.Dictionary(merged(spark, sf), cats.select("category", "url"), d.dict_relationships(found).select("parent", "child"))


@query(
    B + """SELECT k, i AS item, 'https://example.org/' || src || '/Categories/c' || n || '.html' AS category_url,
    CASE i WHEN 'ID' THEN 'https://example.org/' || src || '/Items/_c' || n || '.id.html' ELSE 'https://mmcif.wwpdb.org/dictionaries/mmcif_pdbx_v50.dic/Items/_C' || n || '.none.html' END AS item_url
    FROM s, (VALUES ('ID'), ('none')) v(i)"""
)
def doc_urls(spark, sf):
    s = corpus.table(spark, sf, "supplier")
    names = s.select(
        F.col("s_suppkey").alias("k"), F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("category"),
        F.explode(F.array(F.lit("ID"), F.lit("none"))).alias("item"),
    )
    return d.with_urls(names, _compiled(spark, sf)).select("k", "item", "category_url", "item_url")


@query(B + "SELECT 'c' || n AS category, 'acctbal,id' AS columns FROM s UNION ALL SELECT 'entry', 'id'")
def dict_columns(spark, sf):
    return d.dict_columns(_compiled(spark, sf)).withColumn("columns", F.array_join("columns", ","))


@query(
    B + """SELECT '_c' || n || '.id' AS child, src AS child_source, p AS parent, CASE WHEN k % 4 = 0 THEN 'base0.dic' ELSE 'base' || (k // 4 // 16) || '.dic' END AS parent_source FROM s
    WHERE (k % 4 = 0 AND src <> 'base0.dic') OR (k % 4 = 2 AND k // 4 // 16 <> k // 16)"""
)
def dict_cross_links(spark, sf):
    """Links between items of different sources."""
    items = merged(spark, sf).select("item", "source")
    links = d.dict_relationships(frames(spark, sf)).select("parent", "child")
    child = items.select(F.col("item").alias("child"), F.col("source").alias("child_source"))
    parent = items.select(F.col("item").alias("parent"), F.col("source").alias("parent_source"))
    return links.join(child, "child").join(parent, "parent").filter(F.col("child_source") != F.col("parent_source"))


@query(
    B + """SELECT p.a AS parent, 'c' || n AS child, 'id = id' AS label FROM (SELECT *, CASE k % 4 WHEN 0 THEN 'entry' WHEN 2 THEN 'c' || (k // 4) END AS a FROM s) p WHERE k % 4 IN (0, 2)
    UNION ALL SELECT 'c' || n, NULL, NULL FROM s WHERE k % 4 IN (1, 3) AND NOT EXISTS (SELECT 1 FROM s x WHERE x.k % 4 = 2 AND x.k // 4 = s.k)"""
)
def relationship_graph(spark, sf):
    """Edges per table pair, limited to the categories of the sources; tables without links stay as nodes."""
    compiled = _compiled(spark, sf)
    tables = compiled.category_metadata.select(F.col("category").alias("table_name"))
    return d.relationship_graph(compiled.links(), tables)
