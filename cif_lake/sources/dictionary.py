"""Dictionaries: compile ``.dic`` files to types, links, documentation and category metadata, and look them up.

A dictionary has thousands of items, whatever the size of the data; the compile jobs are DataFrame jobs all the same, so
that many dictionaries (or one per collection) compile side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cif_lake.functions import grammar as g
from cif_lake.operators.relational import use_checkpoints
from cif_lake.sources import seed

ITEMS_SCHEMA = "item string, dtype string, url string"
META_SCHEMA = (
    "category string, keys array<string>, description string, groups array<string>, is_mandatory boolean, "
    "is_single_row boolean, url string"
)
LINKS_SCHEMA = "parent string, child string"


def item_category(item: Column) -> Column:
    """``cat`` of ``_cat.item``."""
    return F.regexp_extract(item, r"^_([^.]*)\.", 1)


def item_column(item: Column) -> Column:
    return F.regexp_extract(item, r"^_[^.]*\.(.*)$", 1)


def dtype_of(code: Column) -> Column:
    """Type of a dictionary code: ``float`` is a double, whole numbers are bigint, the rest (ranges, lists) is text."""
    return F.when(code == "float", "double").when(code.isin("int", "positive_int"), "bigint").otherwise("string")


class Dictionary:
    """Compiled dictionary: ``items``, ``category_metadata`` and ``relationships`` as DataFrames."""

    def __init__(self, items: DataFrame, category_metadata: DataFrame, relationships: DataFrame):
        self.items = items
        self.category_metadata = category_metadata
        self.relationships = relationships

    @classmethod
    def seed(cls, spark: SparkSession) -> Dictionary:
        items, meta = [], []
        for category, (single, names) in seed.CATEGORIES.items():
            url = seed.BASE_URL
            for name in names.split():
                name, _, mark = name.partition(":")
                dtype = {"d": "double", "i": "bigint", "": "string"}[mark]
                items.append((f"_{category}.{name}", dtype, url))
            meta.append((category, None, None, seed.GROUPS.get(category), seed.MANDATORY.get(category), single, url))
        out = cls(
            spark.createDataFrame(items, ITEMS_SCHEMA),
            spark.createDataFrame(meta, META_SCHEMA),
            spark.createDataFrame(seed.LINKS, LINKS_SCHEMA),
        )
        # The seed is known here; no job is needed to look types up.
        out.__dict__["_types"] = {
            i.lower(): (i, t) for i, t, _ in items
        }
        return out

    @cached_property
    def _types(self) -> dict[str, tuple[str, str]]:
        """Item -> (spelling, type). As large as the dictionary (thousands of names), never as the data."""
        return {r["item"].lower(): (r["item"], r["dtype"]) for r in self.items.select("item", "dtype").collect()}

    def item_type(self, category: str, item: str) -> str:
        """Type of an item, unknown items are text."""
        return self._types.get(f"_{category}.{item}".lower(), ("", "string"))[1]

    def columns(self, category: str) -> list[str]:
        """Items of a category, sorted."""
        prefix = f"_{category}.".lower()
        return sorted(name.split(".", 1)[1] for key, (name, _) in self._types.items() if key.startswith(prefix))

    def item_urls(self) -> DataFrame:
        """Documentation address of every item, in the spelling of its dictionary."""
        return self.items.select("item", F.concat("url", F.lit("/Items/"), "item", F.lit(".html")).alias("url"))

    def category_urls(self) -> DataFrame:
        return self.category_metadata.filter(F.col("url").isNotNull()).select(
            "category", F.concat("url", F.lit("/Categories/"), "category", F.lit(".html")).alias("url")
        )

    def links(self) -> DataFrame:
        """Links as ``parent_table, parent_column, child_table, child_column``."""
        return self.relationships.select(
            item_category(F.col("parent")).alias("parent_table"),
            item_column(F.col("parent")).alias("parent_column"),
            item_category(F.col("child")).alias("child_table"),
            item_column(F.col("child")).alias("child_column"),
        )


# --- look-ups as joins -----------------------------------------------------------------------------


def with_types(frame: DataFrame, dictionary: Dictionary, category: str = "category", item: str = "item") -> DataFrame:
    """Add ``dtype``; unknown items are text. The dictionary side is broadcast only if its size allows it."""
    types = dictionary.items.select(F.lower("item").alias("type_key"), "dtype")
    key = F.lower(F.concat(F.lit("_"), F.col(category), F.lit("."), F.col(item)))
    return frame.join(types, key == F.col("type_key"), "left").drop("type_key").withColumn(
        "dtype", F.coalesce("dtype", F.lit("string"))
    )


def with_urls(frame: DataFrame, dictionary: Dictionary, category: str = "category", item: str = "item") -> DataFrame:
    """Add ``category_url`` and ``item_url``; names without documentation point into the base dictionary."""
    items = dictionary.item_urls().select(F.lower("item").alias("ikey"), F.col("url").alias("iurl"))
    cats = dictionary.category_urls().select(F.lower("category").alias("ckey"), F.col("url").alias("curl"))
    tag = F.concat(F.lit("_"), F.col(category), F.lit("."), F.col(item))
    base = F.lit(seed.BASE_URL)
    return (
        frame.join(items, F.lower(tag) == F.col("ikey"), "left")
        .join(cats, F.lower(F.col(category)) == F.col("ckey"), "left")
        .withColumn("item_url", F.coalesce("iurl", F.concat(base, F.lit("/Items/"), tag, F.lit(".html"))))
        .withColumn(
            "category_url", F.coalesce("curl", F.concat(base, F.lit("/Categories/"), F.col(category), F.lit(".html")))
        )
        .drop("ikey", "ckey", "iurl", "curl")
    )


# --- compile ---------------------------------------------------------------------------------------


def _fail_if(frame: DataFrame, bad: Column, message: Column) -> DataFrame:
    """Let the frame pass, or stop the job at the first bad row."""
    return frame.filter(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(True))


def dict_frames(src: DataFrame) -> DataFrame:
    """Values of the top block and of every save frame: ``source, frame_ord, frame, rec_ord, row_id, tag, value``.

    Save frames are cut first, so a file spreads over its frames; unterminated quotes, loops with a partial row and
    items without a value stop the job.
    """
    from cif_lake.sources import read

    lexed = read.text(src).selectExpr("path AS source", f"{g.lexemes('text')} AS lex")
    open_field = f"startswith(x, ';') AND contains(x, '\\n') AND NOT x RLIKE {g.lit(r'(?s)\n;\s*\z')}"
    open_quote = f"x RLIKE {g.lit(r'^[\x27\x22]')} AND NOT x RLIKE {g.lit(r'(?s)^([\x27\x22]).*\1\s*\z')}"
    lexed = _fail_if(
        lexed,
        F.expr(f"exists(lex, x -> ({open_field}) OR ({open_quote}))"),
        F.concat(F.lit("unterminated quote or text field in "), F.col("source")),
    )
    starts = "filter(transform(lex, (x, i) -> CASE WHEN lower(left(x, 5)) = 'save_' THEN i + 1 END), p -> p IS NOT NULL)"
    placed = lexed.selectExpr("*", f"concat(array(1), {starts}) AS starts")
    one = (
        f"named_struct('frame_ord', i, 'frame', CASE WHEN i = 0 THEN '' ELSE {g.header_name('element_at(lex, p)')} END, "
        "'lex', slice(lex, p, coalesce(get(starts, i + 1), size(lex) + 1) - p))"
    )
    cut = read.unroll(placed, ["source"], F.expr(f"transform(starts, (p, i) -> {one})"), "f").selectExpr(
        "0 AS file_ord", "source AS path", "f.frame_ord AS block_ord", "f.frame AS block_name", "f.lex"
    )
    recs = read.records(cut, every=True)
    recs = _fail_if(
        recs,
        ~F.col("is_loop") & F.exists("has", lambda h: ~h),
        F.concat(F.lit("missing value for an item of "), F.col("category"), F.lit(" in "), F.col("path")),
    )
    keep = ["path", "block_ord", "block_name", "rec_ord", "category", "items"]
    rows = read.unroll(recs, keep, "rows", "row_id", "row").selectExpr("*", f"{g.values('row')} AS raw")
    rows = _fail_if(
        rows,
        F.size("raw") < F.size("items"),
        F.concat(F.lit("incomplete loop of "), F.col("category"), F.lit(" in "), F.col("path")),
    )
    cells = F.expr("transform(items, (x, i) -> named_struct('item', x, 'raw', get(raw, i)))")
    keep = ["path", "block_ord", "block_name", "rec_ord", "row_id", "category"]
    cut = read.unroll(rows, keep, cells, "c").select(*keep, "c.item", "c.raw")
    return cut.selectExpr(
        "path AS source",
        "block_ord AS frame_ord",
        "block_name AS frame",
        "rec_ord",
        "CAST(row_id AS bigint) AS row_id",
        "lower(concat('_', category, '.', item)) AS tag",
        f"coalesce({g.unquote('raw')}, raw) AS value",  # . and ? stay text here
    )


def _first() -> Column:
    """Order of the values of one source."""
    return F.struct("frame_ord", "rec_ord", "row_id")


def _is_item() -> Column:
    return F.col("frame").rlike(r"^_.*\.")


def dict_item_types(frames: DataFrame) -> DataFrame:
    """Items of each source with their type: ``source, item, dtype``. The vendor code beats the general one."""
    code = lambda tag: F.min_by(F.when(F.col("tag") == tag, F.col("value")), F.when(F.col("tag") == tag, _first()))
    per_frame = frames.filter(_is_item()).groupBy("source", "frame", "frame_ord").agg(
        F.coalesce(code("_pdbx_item_type.code"), code("_item_type.code")).alias("code")
    )
    typed = per_frame.groupBy("source", F.col("frame").alias("item")).agg(
        F.min(dtype_of(F.col("code"))).alias("dtype"), F.max(dtype_of(F.col("code"))).alias("other")
    )
    return _fail_if(
        typed, F.col("dtype") != F.col("other"), F.concat(F.lit("conflicting save frames for "), F.col("item"))
    ).drop("other")


def dict_relationships(frames: DataFrame) -> DataFrame:
    """Distinct links ``source, parent, child``; links with a missing end are dropped."""
    ends = frames.filter(
        F.col("tag").isin(
            "_item_linked.parent_name",
            "_item_linked.child_name",
            "_pdbx_item_linked_group_list.parent_name",
            "_pdbx_item_linked_group_list.child_name",
        )
    ).withColumn("end", item_column(F.col("tag")))
    paired = ends.groupBy("source", "frame_ord", "rec_ord", "row_id").agg(
        F.max(F.when(F.col("end") == "parent_name", F.col("value"))).alias("parent"),
        F.max(F.when(F.col("end") == "child_name", F.col("value"))).alias("child"),
    )
    paired = _fail_if(
        paired, F.col("parent").isNull() | F.col("child").isNull(), F.concat(F.lit("unpaired link in "), F.col("source"))
    )
    return paired.filter(~F.col("parent").isin(".", "?") & ~F.col("child").isin(".", "?")).select(
        "source", "parent", "child"
    ).distinct()


def dict_categories(frames: DataFrame) -> DataFrame:
    """Categories of each source, the last spelling counts: ``source, key, category``."""
    named = frames.filter((F.col("tag") == "_category.id") & ~F.col("value").isin(".", "?"))
    return named.groupBy("source", F.lower("value").alias("key")).agg(F.max_by("value", _first()).alias("category"))


def dict_versions(frames: DataFrame) -> DataFrame:
    top = frames.filter((F.col("frame") == "") & (F.col("tag") == "_dictionary.version"))
    return top.groupBy("source").agg(F.min_by("value", _first()).alias("version"))


def dict_conflicts(items: DataFrame, resolutions: DataFrame | None = None) -> DataFrame:
    """Items that the sources type differently, and reviewed resolutions that fit nothing.

    ``resolutions(key, types map<source, dtype>, use)``. Gives ``key, types, use, status`` with the status
    ``resolved``, ``unresolved``, ``invalid`` (the chosen source does not define the item) or ``stale``.
    """
    keyed = items.withColumn("key", F.lower("item"))
    differ = keyed.groupBy("key").agg(F.min("dtype").alias("lo"), F.max("dtype").alias("hi")).filter(F.col("lo") != F.col("hi"))
    # Only items in conflict are listed, with one entry per source that defines them.
    found = keyed.join(differ.select("key"), "key", "left_semi").groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("source", "dtype"))).alias("types")
    )
    if resolutions is None:
        # The status hangs on an aggregate, so a check of it is not moved below the test for conflicts.
        status = F.when(F.size("types") > 0, "unresolved")
        return found.select("key", "types", F.lit(None).cast("string").alias("use"), status.alias("status"))
    reviewed = resolutions.select(
        F.col("key").alias("rkey"),
        F.array_sort(
            F.transform(F.map_entries("types"), lambda e: F.struct(e["key"].alias("source"), e["value"].alias("dtype")))
        ).alias("rtypes"),
        "use",
    )
    both = found.join(reviewed, F.col("key") == F.col("rkey"), "full_outer")
    status = (
        F.when(F.col("key").isNull(), "stale")
        .when(F.col("rkey").isNull() | (F.col("types") != F.col("rtypes")), "unresolved")
        .when(~F.array_contains(F.transform("types", lambda t: t["source"]), F.col("use")), "invalid")
        .otherwise("resolved")
    )
    return both.select(
        F.coalesce("key", "rkey").alias("key"), F.coalesce("types", "rtypes").alias("types"), "use", status.alias("status")
    )


def dict_merge(items: DataFrame, sources: DataFrame, resolutions: DataFrame | None = None) -> DataFrame:
    """Merge the items of all sources: ``item, dtype, url, source``; the first source owns spelling and documentation.

    ``sources(source, priority, documentation_url)``. Type conflicts need a resolution, which then owns the item.
    """
    ranked = items.join(sources, "source").withColumn("key", F.lower("item"))
    conflicts = dict_conflicts(items, resolutions)
    conflicts = _fail_if(
        conflicts, F.col("status") != "resolved", F.concat(F.col("status"), F.lit(" type conflict: "), F.col("key"))
    )
    chosen = ranked.join(conflicts.select("key", "use"), "key", "left")
    order = F.struct(F.coalesce(F.col("use") != F.col("source"), F.lit(True)).alias("other"), "priority")
    best = chosen.groupBy("key").agg(
        F.min_by(F.struct("item", "dtype", F.col("documentation_url").alias("url"), "source"), order).alias("b")
    )
    return best.select("b.item", "b.dtype", "b.url", "b.source")


def dict_merge_categories(categories: DataFrame, sources: DataFrame) -> DataFrame:
    """First source of a category owns its spelling and documentation: ``key, category, url``."""
    best = categories.join(sources, "source").groupBy("key").agg(
        F.min_by(F.struct("category", F.col("documentation_url").alias("url")), "priority").alias("b")
    )
    return best.select("key", "b.category", "b.url")


def dict_canonical_links(links: DataFrame, merged: DataFrame) -> DataFrame:
    """Links in the spelling of the merged items, case variants folded."""
    spelled = merged.select(F.lower("item").alias("key"), "item")
    ends = links.select(F.lower("parent").alias("pk"), F.lower("child").alias("ck")).distinct()
    return (
        ends.join(spelled.select(F.col("key").alias("pk"), F.col("item").alias("p")), "pk", "left")
        .join(spelled.select(F.col("key").alias("ck"), F.col("item").alias("c")), "ck", "left")
        .select(F.coalesce("p", "pk").alias("parent"), F.coalesce("c", "ck").alias("child"))
        .distinct()
    )


def dict_category_metadata(frames: DataFrame) -> DataFrame:
    """Per source and category: sorted distinct keys and groups, trimmed description, mandatory code as boolean."""
    known = ~F.col("value").isin(".", "?")
    first = lambda tag: F.min_by(
        F.when((F.col("tag") == tag) & known, F.col("value")), F.when((F.col("tag") == tag) & known, _first())
    )
    per_frame = frames.groupBy("source", "frame_ord").agg(
        first("_category.id").alias("category"),
        F.array_sort(F.collect_set(F.when(F.col("tag") == "_category_key.name", F.lower("value")))).alias("keys"),
        first("_category.description").alias("description"),
        F.array_sort(F.collect_set(F.when((F.col("tag") == "_category_group.id") & known, F.col("value")))).alias("groups"),
        first("_category.mandatory_code").alias("mandatory"),
    )
    code = F.lower("mandatory")
    return per_frame.filter(F.col("category").isNotNull()).select(
        "source",
        F.lower("category").alias("category"),
        "keys",
        F.regexp_replace("description", r"^\s+|\s+\z", "").alias("description"),
        F.when(F.size("groups") > 0, F.col("groups")).alias("groups"),
        F.when(code == "yes", True).when(code == "no", False).alias("is_mandatory"),
    )


def dict_item_names(frames: DataFrame) -> DataFrame:
    """All defined item names, lower case: named frames and ``_item.name`` values."""
    framed = frames.filter(_is_item()).select(F.lower("frame").alias("item"))
    named = frames.filter((F.col("tag") == "_item.name") & ~F.col("value").isin(".", "?")).select(F.lower("value").alias("item"))
    return framed.unionAll(named).distinct()


def dict_parents(frames: DataFrame) -> DataFrame:
    """Links that constrain row limits: a missing parent is kept, it makes the limit unknown."""
    ends = frames.filter(
        F.col("tag").rlike(r"^_(item_linked|pdbx_item_linked_group_list)\.(parent|child)_name$")
    ).withColumn("end", item_column(F.col("tag")))
    paired = ends.groupBy("source", "frame_ord", "rec_ord", "row_id").agg(
        F.max(F.when(F.col("end") == "parent_name", F.lower("value"))).alias("parent"),
        F.max(F.when(F.col("end") == "child_name", F.lower("value"))).alias("child"),
    )
    return paired.filter(F.col("parent").isNotNull() & ~F.col("child").isin(".", "?")).select("parent", "child").distinct()


def _grow(start: DataFrame, step) -> DataFrame:
    """Least fixpoint of ``known -> step(known)`` over one-column sets; lineage is cut with reliable checkpoints."""
    known = start.distinct().checkpoint()
    size = known.count()
    while True:
        known = known.unionAll(step(known)).distinct().checkpoint()
        grown = known.count()
        if grown == size:
            return known
        size = grown


def dict_row_constraints(metadata: DataFrame, parents: DataFrame, items: DataFrame) -> DataFrame:
    """Row limit of each category: ``category, is_single_row``.

    True when every key is fixed by ``_entry.id`` (through links or other single-row categories); False when all keys are
    known items and one of them varies; NULL (unknown) otherwise, as for cycles and unresolved links.
    """
    spark = metadata.sparkSession
    use_checkpoints(spark)
    keys = metadata.filter(F.size("keys") > 0).select("category", F.explode("keys").alias("key")).checkpoint()
    items = items.select("item").distinct().withColumn("category", item_category(F.col("item"))).checkpoint()
    parents = parents.checkpoint()

    def with_all(flagged: DataFrame) -> DataFrame:
        """Categories all of whose keys are in the one-column frame ``flagged``."""
        hit = keys.join(flagged.select(F.col("item").alias("key"), F.lit(1).alias("hit")), "key", "left")
        return hit.groupBy("category").agg(F.every(F.col("hit").isNotNull()).alias("all")).filter("all").select("category")

    # Fixed items and single-row categories grow together.
    anchor = metadata.filter((F.col("category") == "entry") & (F.col("keys") == F.array(F.lit("_entry.id")))).select(
        F.lit("_entry.id").alias("item")
    )

    def more_fixed(fixed: DataFrame) -> DataFrame:
        children = parents.join(fixed, F.col("parent") == F.col("item")).select(F.col("child").alias("item"))
        return children.unionAll(items.join(with_all(fixed), "category", "left_semi").select("item"))

    fixed = _grow(anchor, more_fixed)
    single = with_all(fixed).checkpoint()

    known = with_all(items.select("item")).join(single, "category", "left_anti").checkpoint()
    open_keys = keys.join(known, "category", "left_semi")
    # Items that may vary: defined and not fixed.
    free = items.join(fixed, "item", "left_anti").checkpoint()
    roots = open_keys.join(parents, F.col("key") == F.col("child"), "left_anti").join(
        fixed, F.col("key") == F.col("item"), "left_anti"
    ).select("category").distinct()
    unlinked = free.join(parents, F.col("item") == F.col("child"), "left_anti")
    linked = free.select("item").join(parents, F.col("item") == F.col("child")).select("item", "parent").checkpoint()
    own_keys = keys.select(F.col("key").alias("item"), F.col("category").alias("kcat"))

    def variable_of(multiple: DataFrame) -> DataFrame:
        """Unlinked keys of multi-row categories."""
        return (
            unlinked.join(multiple, "category", "left_semi")
            .join(own_keys, "item")
            .filter(F.col("category") == F.col("kcat"))
            .select("item")
        )

    def more_variable(variable: DataFrame) -> DataFrame:
        # A linked item varies when all its parents do; a category is multi-row when one of its keys varies.
        hit = linked.join(variable.select(F.col("item").alias("parent"), F.lit(1).alias("hit")), "parent", "left")
        by_links = hit.groupBy("item").agg(F.every(F.col("hit").isNotNull()).alias("all")).filter("all").select("item")
        multiple = open_keys.join(variable, F.col("key") == F.col("item"), "left_semi").select("category").distinct()
        return by_links.unionAll(variable_of(multiple))

    variable = _grow(variable_of(roots), more_variable)
    multiple = open_keys.join(variable, F.col("key") == F.col("item"), "left_semi").select("category").unionAll(roots).distinct()
    return (
        metadata.select("category")
        .join(single.withColumn("one", F.lit(True)), "category", "left")
        .join(multiple.withColumn("many", F.lit(False)), "category", "left")
        .select("category", F.coalesce("one", "many").alias("is_single_row"))
    )


def escape_text(value: Column) -> Column:
    """One-line form of a text."""
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return value


def unescape_text(value: Column) -> Column:
    """Inverse of :func:`escape_text`: a backslash pair is parked on a control character meanwhile."""
    parked = F.replace(value, F.lit("\\\\"), F.lit("\x00"))
    for escaped, plain in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\x00", "\\")):
        parked = F.replace(parked, F.lit(escaped), F.lit(plain))
    return parked


def dict_long_rows(metadata: DataFrame) -> DataFrame:
    """Metadata in long form ``category, field, value`` with escaped text."""
    one = lambda field, value: F.array(F.struct(F.lit(field).alias("field"), value.alias("value")))
    many = lambda field, values: F.transform(values, lambda v: F.struct(F.lit(field).alias("field"), v.alias("value")))
    fields = F.concat(
        one("category", F.col("category")),
        one("is_single_row", F.col("is_single_row").cast("string")),
        one("description", F.col("description")),
        one("is_mandatory", F.col("is_mandatory").cast("string")),
        many("key", F.coalesce("keys", F.array().cast("array<string>"))),
        many("group", F.coalesce("groups", F.array().cast("array<string>"))),
    )
    return (
        metadata.select("category", F.explode(fields).alias("f"))
        .filter(F.col("f.value").isNotNull())
        .select("category", "f.field", escape_text(F.col("f.value")).alias("value"))
    )


def dict_from_long_rows(rows: DataFrame) -> DataFrame:
    """Inverse of :func:`dict_long_rows`."""
    plain = rows.withColumn("value", unescape_text(F.col("value")))
    one = lambda field: F.max(F.when(F.col("field") == field, F.col("value")))
    many = lambda field: F.array_sort(F.collect_set(F.when(F.col("field") == field, F.col("value"))))
    return plain.groupBy("category").agg(
        many("key").alias("keys"),
        one("description").alias("description"),
        F.when(F.size(many("group")) > 0, many("group")).alias("groups"),
        one("is_mandatory").cast("boolean").alias("is_mandatory"),
        one("is_single_row").cast("boolean").alias("is_single_row"),
    )


def dict_verify(src: DataFrame, manifest: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """Check sources against ``manifest(source, sha256, version)`` before use: ``source, sha256, ok``; bad ones stop the job."""
    found = src.select(F.col("path").alias("source"), F.sha2(F.col("content").cast("binary"), 256).alias("found"))
    checked = manifest.join(found, "source", "left")
    checked = _fail_if(
        checked,
        ~F.coalesce(F.col("found") == F.col("sha256"), F.lit(False)),
        F.concat(F.lit("checksum mismatch: "), F.col("source")),
    )
    if versions is not None:
        checked = checked.join(versions.withColumnRenamed("version", "found_version"), "source", "left")
        checked = _fail_if(
            checked,
            ~F.coalesce(F.col("found_version") == F.col("version"), F.lit(False)),
            F.concat(F.lit("version mismatch: "), F.col("source")),
        )
    return checked.select("source", F.col("found").alias("sha256"), F.lit(True).alias("ok"))


def compile_dictionary(src: DataFrame, sources: DataFrame, resolutions: DataFrame | None = None) -> Dictionary:
    """All compile jobs in one: ``sources(source, priority, documentation_url)`` names the ``.dic`` files of ``src``."""
    frames = dict_frames(src).persist()
    merged = dict_merge(dict_item_types(frames), sources, resolutions)
    urls = dict_merge_categories(dict_categories(frames), sources)
    links = dict_canonical_links(dict_relationships(frames), merged)
    meta = dict_category_metadata(frames).join(sources, "source")
    fields = F.struct("keys", "description", "groups", "is_mandatory")
    meta = meta.groupBy("category").agg(F.min_by(fields, "priority").alias("m")).select("category", "m.*")
    limits = dict_row_constraints(
        meta, dict_parents(frames), dict_item_names(frames).unionAll(merged.select(F.lower("item").alias("item")))
    )
    spelled = urls.select("key", F.col("category").alias("spelling"), "url")
    meta = meta.join(limits, "category").join(spelled, F.col("category") == F.col("key"), "left").select(
        F.coalesce("spelling", "category").alias("category"), "keys", "description", "groups", "is_mandatory", "is_single_row", "url"
    )
    return Dictionary(merged.select("item", "dtype", "url"), meta, links)


def dict_columns(dictionary: Dictionary) -> DataFrame:
    """Ordered items of each category: ``category, columns``."""
    return dictionary.items.groupBy(F.lower(item_category(F.col("item"))).alias("category")).agg(
        F.array_sort(F.collect_list(item_column(F.col("item")))).alias("columns")
    )


def write_artifacts(dictionary: Dictionary, directory: str) -> None:
    """TSV artifacts, sorted over their part files: the parts of one artifact, joined by name, are the same for the same input."""
    tables = {
        "types": dictionary.items.select("item", "dtype"),
        "documentation": dictionary.items.select(F.col("item").alias("key"), "url").unionAll(
            dictionary.category_metadata.select(F.col("category").alias("key"), "url")
        ),
        "relationships": dictionary.relationships.select("parent", "child"),
        "categories": dict_long_rows(dictionary.category_metadata),
    }
    for name, table in tables.items():
        lines = table.select(F.concat_ws("\t", *table.columns).alias("line")).orderBy("line")
        lines.write.mode("overwrite").text(f"{directory}/{name}")


def read_artifacts(spark: SparkSession, directory: str) -> Dictionary:
    """Load what :func:`write_artifacts` wrote."""

    def table(name: str, columns: Sequence[str]) -> DataFrame:
        parts = F.split("value", "\t")
        return spark.read.text(f"{directory}/{name}").select(*[F.get(parts, i).alias(c) for i, c in enumerate(columns)])

    urls = table("documentation", ["key", "url"])
    items = table("types", ["item", "dtype"]).join(urls, F.col("item") == F.col("key"), "left").drop("key")
    meta = dict_from_long_rows(table("categories", ["category", "field", "value"]))
    meta = meta.join(urls, F.col("category") == F.col("key"), "left").drop("key")
    return Dictionary(items, meta, table("relationships", ["parent", "child"]))


# --- relationship graph ------------------------------------------------------------------------------


def relationship_graph(links: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Diagram as data: one row per table pair, ``parent, child, label``; tables without links have a NULL child.

    ``tables(table_name)`` limits the graph, for instance to one dictionary or a name prefix.
    """
    pairs = links.distinct()
    if tables is not None:
        allowed = tables.select(F.lower("table_name").alias("allowed")).distinct()
        pairs = pairs.join(allowed, F.lower("parent_table") == F.col("allowed"), "left_semi").join(
            allowed, F.lower("child_table") == F.col("allowed"), "left_semi"
        )
    label = F.concat("parent_column", F.lit(" = "), "child_column")
    edges = pairs.groupBy(F.col("parent_table").alias("parent"), F.col("child_table").alias("child")).agg(
        F.array_join(F.array_sort(F.collect_list(label)), ", ").alias("label")
    )
    if tables is None:
        return edges
    ends = edges.select("parent").unionAll(edges.select(F.col("child").alias("parent"))).distinct()
    alone = tables.select(F.col("table_name").alias("parent")).distinct().join(ends, "parent", "left_anti")
    return edges.unionAll(alone.select("parent", F.lit(None).cast("string").alias("child"), F.lit(None).cast("string").alias("label")))


def graph_columns(links: DataFrame) -> DataFrame:
    """Linked columns per table: ``table_name, columns``."""
    ends = links.select(F.col("parent_table").alias("t"), F.col("parent_column").alias("c")).unionAll(
        links.select(F.col("child_table").alias("t"), F.col("child_column").alias("c"))
    )
    return ends.groupBy(F.col("t").alias("table_name")).agg(F.array_sort(F.collect_set("c")).alias("columns"))


def mermaid_lines(graph: DataFrame) -> DataFrame:
    """Edges of the graph as lines of a Mermaid diagram."""
    return graph.filter(F.col("child").isNotNull()).select(
        F.format_string('    %s ||--o{ %s : "%s"', "parent", "child", "label").alias("line")
    )
