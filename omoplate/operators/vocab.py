"""Vocabulary mapping: source value -> source concept -> standard concept.

J1-J9, J13, J14, F3, A8, A9. Every lookup is a left equi-join against a
deduplicated lookup table (one row per key, so no fan-out). "Last row
wins" of a dictionary build becomes an explicit rule: the greatest value,
or the value at the greatest ``order_column`` when one is given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omoplate.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small

MAPS_TO = "Maps to"
# Literal dictionaries up to this size become an inline map expression;
# larger ones are joined as a table, with the same types and results.
INLINE_MAP_ENTRIES = 5_000


# -- helpers ------------------------------------------------------------------

def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[tuple[Column | str, str]]) -> DataFrame:
    """Left-join ``df`` to a lookup with unique keys.

    ``on`` pairs a left expression with a lookup key column. ``df`` is used
    once. The lookup's rows are counted, and one within the bound is
    broadcast, so the data are not shuffled for it: by Spark's estimate,
    which is the vocabulary's size and not the lookup's, they would be as
    soon as the vocabulary is large. Beyond the bound Spark joins by a
    shuffle, where it splits skewed keys.
    """
    keys = [(F.col(l) if isinstance(l, str) else l, r) for l, r in on]
    names = [f"_lk{i}" for i in range(len(keys))]
    left = df.withColumns({n: l for n, (l, _) in zip(names, keys)})
    right = broadcast_if_small(lookup.withColumnsRenamed({r: n for (_, r), n in zip(keys, names)}))
    return left.join(right, names, "left").drop(*names)


def _pick(value: str, order_column: str | None) -> Column:
    return F.max_by(value, order_column) if order_column else F.max(value)


def unmapped(c: Column | str, is_string: bool = False) -> Column:
    """null, 0 (or "" for a string column) means unmapped."""
    col = F.col(c) if isinstance(c, str) else c
    cond = col.isNull() | (col == 0) if not is_string else col.isNull() | (col == "")
    return F.coalesce(cond, F.lit(True))


def _is_string(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column] == "string"


# -- J1 -----------------------------------------------------------------------

def source_value_lookup(concept: DataFrame, target_vocab: Mapping[str, str],
                        order_column: str | None = None) -> DataFrame:
    """(vocabulary, key) -> concept_id for the configured vocabularies.

    One scan of CONCEPT: each row's key is the column its vocabulary maps
    by (``concept_name`` or ``concept_code``).
    """
    if not target_vocab:
        raise ValueError("no vocabulary configured")
    key = None
    for vocab, target in target_vocab.items():
        if target not in ("concept_name", "concept_code"):
            raise ValueError(f"unknown mapping target {target!r} for {vocab}")
        key = (F.when(F.col("vocabulary_id") == vocab, F.col(target)) if key is None
               else key.when(F.col("vocabulary_id") == vocab, F.col(target)))
    cols = ["vocabulary_id", "concept_id"] + ([order_column] if order_column else [])
    subset = concept.filter(F.col("vocabulary_id").isin(list(target_vocab))).select(*cols, key.alias("_key"))
    return (subset.filter(F.col("_key").isNotNull())
            .groupBy(F.col("vocabulary_id").alias("_vocab"), "_key")
            .agg(_pick("concept_id", order_column).cast("long").alias("_cid")))


def map_source_value(df: DataFrame, target_vocab: Mapping[str, str], concept: DataFrame,
                     source_column: str = "source_value", vocabulary_column: str = "vocabulary_id",
                     concept_id_column: str = "source_concept_id", order_column: str | None = None) -> DataFrame:
    """Source value -> concept id within the row's vocabulary.

    Rows of a vocabulary mapped by name match ``concept_name``, by code
    ``concept_code``. Unmatched rows and rows of unconfigured vocabularies
    get null. The output column is rebuilt on every call.
    """
    lookup = source_value_lookup(concept, target_vocab, order_column)
    base = df.drop(concept_id_column) if concept_id_column in df.columns else df
    out = lookup_join(base, lookup, [(F.col(vocabulary_column), "_vocab"),
                                     (F.col(source_column).cast("string"), "_key")])
    return out.withColumnRenamed("_cid", concept_id_column)


# -- J2 -----------------------------------------------------------------------

def maps_to_lookup(concept_relationship: DataFrame, order_column: str | None = None) -> DataFrame:
    edges = concept_relationship.filter(F.col("relationship_id") == MAPS_TO)
    return edges.groupBy(F.col("concept_id_1").cast("long").alias("_c1")).agg(
        _pick("concept_id_2", order_column).cast("long").alias("_c2"))


def map_source_concept_id(df: DataFrame, concept_relationship: DataFrame,
                          source_column: str = "source_concept_id", concept_id_column: str = "concept_id",
                          order_column: str | None = None) -> DataFrame:
    """Follow the ``Maps to`` edge; no edge (or no source concept) -> 0."""
    base = df.drop(concept_id_column) if concept_id_column in df.columns and concept_id_column != source_column else df
    source = F.col(source_column).try_cast("long")  # "" or other non-ids count as unmapped
    out = lookup_join(base, maps_to_lookup(concept_relationship, order_column), [(source, "_c1")])
    return out.withColumns({
        source_column: source,
        concept_id_column: F.coalesce(F.col("_c2"), F.lit(0)).cast("long"),
    }).drop("_c2")


# -- J1 + J2 ------------------------------------------------------------------

def standard_lookup(concept: DataFrame, concept_relationship: DataFrame, target_vocab: Mapping[str, str],
                    order_column: str | None = None) -> DataFrame:
    """(vocabulary, key) -> source concept and standard concept (0 without a ``Maps to`` edge),
    composed before any fact row is touched."""
    source = source_value_lookup(concept, target_vocab, order_column)
    edges = maps_to_lookup(concept_relationship, order_column)
    return source.join(edges, source["_cid"] == edges["_c1"], "left").select(
        "_vocab", "_key", "_cid", F.coalesce("_c2", F.lit(0)).cast("long").alias("_std"))


def map_to_standard(df: DataFrame, target_vocab: Mapping[str, str], concept: DataFrame,
                    concept_relationship: DataFrame, source_column: str, vocabulary_column: str,
                    source_concept_id_column: str, concept_id_column: str,
                    order_column: str | None = None) -> DataFrame:
    """J1 then J2 in one join: null source concept and standard concept 0 where nothing matches."""
    lookup = standard_lookup(concept, concept_relationship, target_vocab, order_column)
    base = df.drop(source_concept_id_column, concept_id_column)
    out = lookup_join(base, lookup, [(F.col(vocabulary_column), "_vocab"),
                                     (F.col(source_column).cast("string"), "_key")])
    return out.withColumns({source_concept_id_column: F.col("_cid"),
                            concept_id_column: F.coalesce("_std", F.lit(0)).cast("long")}).drop("_cid", "_std")


# -- J3 -----------------------------------------------------------------------

def value_lookup(vocabulary: DataFrame, code_column: str, value_column: str,
                 order_column: str | None = None) -> DataFrame:
    """J3 (build): code -> value, one value per code (the greatest, or that at the greatest ``order_column``)."""
    return vocabulary.groupBy(F.col(code_column).alias("_code")).agg(_pick(value_column, order_column).alias("_value"))


def apply_value_lookup(df: DataFrame, vocabulary: DataFrame, source_column: str, code_column: str,
                       value_column: str, output: str, order_column: str | None = None) -> DataFrame:
    """J3 (apply): ``output`` = value of the row's code, null when absent."""
    base = df.drop(output) if output in df.columns else df
    out = lookup_join(base, value_lookup(vocabulary, code_column, value_column, order_column),
                      [(F.col(source_column), "_code")])
    return out.withColumnRenamed("_value", output)


# -- J4 -----------------------------------------------------------------------

UNIT_VOCABULARIES = ("UCUM", "SNOMED")


def unit_lookup(concept: DataFrame, order_column: str | None = None) -> DataFrame:
    """unit text -> (vocabulary, source concept): by UCUM code, else by SNOMED name."""
    units = concept.filter((F.col("domain_id") == "Unit") & F.col("vocabulary_id").isin(*UNIT_VOCABULARIES))
    found = source_value_lookup(units, {"UCUM": "concept_code", "SNOMED": "concept_name"}, order_column)
    # "UCUM" sorts after "SNOMED", so the greatest pair is the preferred one
    best = found.groupBy("_key").agg(F.max(F.struct("_vocab", "_cid")).alias("_best"))
    return best.select("_key", "_best._vocab", "_best._cid")


def map_units(df: DataFrame, concept: DataFrame, source_column: str = "unit_source_value",
              order_column: str | None = None) -> DataFrame:
    """Units by UCUM code first, then by SNOMED name for the rest.

    Adds ``unit_vocabulary_id`` (UCUM when the code matched, else SNOMED)
    and ``unit_source_concept_id``.
    """
    base = df.drop("unit_vocabulary_id", "unit_source_concept_id")
    out = lookup_join(base, unit_lookup(concept, order_column), [(F.col(source_column), "_key")])
    return out.withColumns({"unit_vocabulary_id": F.coalesce("_vocab", F.lit("SNOMED")),
                            "unit_source_concept_id": F.col("_cid")}).drop("_vocab", "_cid")


def map_lab_units(df: DataFrame, units: DataFrame, concept: DataFrame, concept_relationship: DataFrame,
                  name_column: str, unit_name: str, unit_text: str, order_column: str | None = None) -> DataFrame:
    """J3, J4 and J2 for units in one join: lab name -> unit text, source and standard concept.

    ``units`` holds a lab's name in ``unit_name`` and its unit in
    ``unit_text``. Adds ``unit_source_value``, ``unit_vocabulary_id``,
    ``unit_source_concept_id`` and ``unit_concept_id``. A table without
    ``order_column`` gives a name's greatest value.
    """
    by = order_column if order_column in units.columns else None
    texts = value_lookup(units, unit_name, unit_text, by).withColumnRenamed("_value", "_key")
    edges = maps_to_lookup(concept_relationship, order_column)
    table = texts.join(unit_lookup(concept, order_column), "_key", "left")
    table = table.join(edges, table["_cid"] == edges["_c1"], "left").select("_code", "_key", "_vocab", "_cid", "_c2")
    base = df.drop("unit_source_value", "unit_vocabulary_id", "unit_source_concept_id", "unit_concept_id")
    out = lookup_join(base, table, [(F.col(name_column), "_code")])
    return out.withColumns({"unit_source_value": F.col("_key"), "unit_vocabulary_id": F.coalesce("_vocab", F.lit("SNOMED")),
                            "unit_source_concept_id": F.col("_cid"),
                            "unit_concept_id": F.coalesce("_c2", F.lit(0)).cast("long")}).drop("_key", "_vocab", "_cid", "_c2")


# -- J5 / J6 / J15 ------------------------------------------------------------

def _key_type(mapping: Mapping) -> str:
    """Keys are compared as text unless all are whole numbers, or all are numbers."""
    kinds = {type(k) for k in mapping}
    return "bigint" if kinds == {int} else "double" if kinds <= {int, float} else "string"


def literal_lookup(df: DataFrame, column: str | Column, mapping: Mapping) -> Column:
    """Value of ``column`` in a literal dictionary (null when absent, or when the value is no such key at all)."""
    col = F.col(column) if isinstance(column, str) else column
    if not mapping:
        return F.lit(None)
    kind = _key_type(mapping)
    pairs = [x for k, v in mapping.items() for x in (F.lit(str(k) if kind == "string" else k).cast(kind), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), col.try_cast(kind))


def apply_source_mapping(df: DataFrame, value_mappings: Mapping[str, Mapping],
                         output_columns: Mapping[str, str] | None = None) -> DataFrame:
    """``<x>_source_value`` -> ``<x>_concept_id`` from literal dictionaries.

    Small dictionaries are inline map expressions; a large one is joined as
    a lookup table with the same key and value types.
    """
    output_columns = output_columns or {}
    out = df
    for source, mapping in value_mappings.items():
        target = output_columns.get(source, source.replace("_source_value", "_concept_id"))
        if len(mapping) <= INLINE_MAP_ENTRIES:
            out = out.withColumn(target, literal_lookup(out, source, mapping))
        else:
            kind = _key_type(mapping)
            value = next((v for v in mapping.values() if v is not None), None)
            value_type = df.sparkSession.range(1).select(F.lit(value).alias("v")).dtypes[0][1]
            rows = [(str(k) if kind == "string" else k, v) for k, v in mapping.items()]
            names = {"bigint": int, "double": float}.get(kind, str)
            table = df.sparkSession.createDataFrame([(names(k), v) for k, v in rows], ["_k", "_v"]).select(
                F.col("_k").cast(kind).alias("_k"), F.col("_v").cast(value_type).alias(target))
            base = out.drop(target)
            out = lookup_join(base, table, [(F.col(source).try_cast(kind), "_k")])
    return out


def transform_gender(df: DataFrame, code_column: str, label_column: str, mapping: Mapping) -> DataFrame:
    """Gender concept from the code column; every code must be mapped.

    Adds ``gender_concept_id``, ``gender_source_concept_id`` (the code) and
    ``gender_source_value`` (the label); an unmapped code raises TypeError.
    """
    mapped = literal_lookup(df, code_column, mapping)
    out = df.withColumns({"gender_concept_id": mapped,
                          "gender_source_concept_id": F.col(code_column),
                          "gender_source_value": F.col(label_column)})
    if out.filter(F.col("gender_concept_id").isNull()).limit(1).count():
        raise TypeError(f"{code_column} holds a code that the gender mapping lacks")
    return out


# -- J7 -----------------------------------------------------------------------

def fallback_mapping(df: DataFrame, concept: DataFrame, concept_relationship: DataFrame,
                     fallback_vocabs: Mapping[str, str], source_value_column: str,
                     source_concept_id_column: str, concept_id_column: str,
                     vocabulary_id_column: str = "vocabulary_id",
                     order_column: str | None = None) -> tuple[DataFrame, Column]:
    """Retry unmapped rows with other vocabularies, in order.

    Mapped rows are untouched. An unmapped row takes the first fallback
    vocabulary whose source concept reaches a standard concept; a row that
    reaches none ends with the last vocabulary tried and whatever source
    concept it gave. The vocabularies are put in order on their own side, so
    the data meet one lookup however many there are. Returns the data and
    the still-unmapped condition.
    """
    vocabs = list(fallback_vocabs.items())
    if not vocabs:
        return df, unmapped(concept_id_column)
    last = vocabs[-1][0]
    found = standard_lookup(concept, concept_relationship, fallback_vocabs, order_column)
    place = literal_lookup(found, "_vocab", {vocab: i for i, (vocab, _) in enumerate(vocabs)})
    # one row a key: the first vocabulary in which it reaches a standard concept, and what the last one gives
    lookup = found.groupBy("_key").agg(
        F.min(F.when(F.col("_std") != 0, F.struct(place.alias("_place"), "_vocab", "_cid", "_std"))).alias("_hit"),
        F.max(F.when(F.col("_vocab") == last, F.col("_cid"))).alias("_last"))
    out = df.withColumn("_fb_open", unmapped(concept_id_column, _is_string(df, concept_id_column)))
    # rows that are mapped already get keys that match nothing and lie apart, not one null for all
    text = F.col(source_value_column).cast("string")
    closed = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*df.columns), F.lit(4096)).cast("string"))
    out = lookup_join(out, lookup, [(F.when(F.col("_fb_open"), text).otherwise(closed), "_key")])
    hit, open_ = F.col("_hit").isNotNull(), F.col("_fb_open")
    out = out.withColumns({
        vocabulary_id_column: F.when(open_, F.coalesce("_hit._vocab", F.lit(last))).otherwise(F.col(vocabulary_id_column)),
        source_concept_id_column: F.when(open_ & hit, F.col("_hit._cid")).when(open_, F.col("_last"))
        .otherwise(F.col(source_concept_id_column)).cast("long"),
        concept_id_column: F.when(open_, F.coalesce("_hit._std", F.lit(0))).otherwise(F.col(concept_id_column)).cast("long"),
    })
    return out.drop("_fb_open", "_hit", "_last"), unmapped(concept_id_column)


# -- J8 / J9 ------------------------------------------------------------------

def update_concept_mappings(df: DataFrame, source_column: str, target_column: str,
                            new_concept_mappings: Mapping, check_empty: bool = True) -> DataFrame:
    """Literal overrides, applied only to unmapped rows.

    An empty input raises ``ValueError`` when ``check_empty`` (one probe
    job); pipelines pass False, where an empty table simply stays empty.
    """
    if source_column not in df.columns:
        raise KeyError(f"no column {source_column!r} to look values up by")
    if target_column not in df.columns:
        raise KeyError(f"no column {target_column!r} to put concepts into")
    if check_empty and df.limit(1).count() == 0:
        raise ValueError("there are no rows to map")
    if not new_concept_mappings:
        return df
    is_str = _is_string(df, target_column)
    mapped = literal_lookup(df, source_column, new_concept_mappings)
    if is_str:
        mapped = mapped.cast("string")
    return df.withColumn(target_column, F.when(unmapped(target_column, is_str) & mapped.isNotNull(), mapped)
                         .otherwise(F.col(target_column)))


def check_overrides_standard(concept: DataFrame, overrides: Mapping, allow_zero: bool = True) -> None:
    """Every override target must be a standard concept (``standard_concept='S'``)."""
    targets = sorted({int(v) for v in overrides.values()})
    wanted = [t for t in targets if not (allow_zero and t == 0)]
    if not wanted:
        return
    found = {r[0] for r in concept.filter((F.col("standard_concept") == "S") & F.col("concept_id").isin(wanted))
             .select("concept_id").distinct().collect()}
    bad = [t for t in wanted if t not in found]
    if bad:
        raise AssertionError(f"override targets that are no standard concepts: {bad}")


def check_unmapped_values(df: DataFrame, params: Mapping, fields: Sequence[str], concept: DataFrame | None = None,
                          variant: str = "measurement") -> DataFrame:
    """For each field, apply configured overrides ``unmapped_<field>``.

    ``measurement`` checks override targets are standard (0 allowed),
    ``drug`` checks them without the 0 exception, ``provider`` does not
    check. Only unmapped rows change.
    """
    for field in fields:
        overrides = params.get(f"unmapped_{field}")
        if not overrides:
            continue
        if variant in ("measurement", "drug") and concept is not None:
            check_overrides_standard(concept, overrides, allow_zero=variant == "measurement")
        df = update_concept_mappings(df, f"{field}_source_value", f"{field}_concept_id", overrides,
                                     check_empty=False)
    return df


# -- A8 / A9 ------------------------------------------------------------------

def find_unmapped_values(df: DataFrame, source_value_column: str, concept_id_column: str) -> DataFrame:
    """Distinct source values of unmapped rows (a DataFrame, not a list)."""
    cond = unmapped(concept_id_column, _is_string(df, concept_id_column))
    return df.filter(cond).select(source_value_column).distinct()


def report_unmapped(df: DataFrame, unmapped_values: DataFrame, source_value_column: str,
                    source_concept_id_column: str, concept_id_column: str,
                    extra_cols: Sequence[str] = ("vocabulary_id", "type_concept")) -> DataFrame:
    """Every distinct (value, ids, extras) row of a value that is unmapped
    somewhere, including rows where the same value did map. The sink sorts."""
    cols = [source_value_column, source_concept_id_column, concept_id_column, *extra_cols]
    hits = df.select(*cols).distinct()  # few rows: the semi-join runs on these
    return hits.join(unmapped_values.select(source_value_column).distinct(), source_value_column, "left_semi").select(*cols)


def unmapped_summary(df: DataFrame, source_value_column: str, source_concept_id_column: str, concept_id_column: str,
                     extra_cols: Sequence[str] = ("vocabulary_id", "type_concept")) -> DataFrame:
    """A8 and A9 with one pass over ``df``, and none before the report is used: the distinct rows of a value lie
    together and all stay if one of them is unmapped. Nothing is written."""
    cols = [source_value_column, source_concept_id_column, concept_id_column, *extra_cols]
    cond = unmapped(concept_id_column, _is_string(df, concept_id_column))
    some = F.max(cond).over(Window.partitionBy(source_value_column))
    distinct = df.filter(F.col(source_value_column).isNotNull()).select(*cols).distinct()
    return distinct.withColumn("_open", some).filter("_open").select(*cols)


# -- J13 / J14 ----------------------------------------------------------------

def wide_relationship(concept: DataFrame, concept_relationship: DataFrame,
                      concept_right: DataFrame | None = None) -> DataFrame:
    """CONCEPT_1 + (ci_1, relationship, ci_2) + CONCEPT_2, left joins."""
    left = concept.select(*[F.col(c).alias(c + "_1") for c in concept.columns])
    right_src = concept_right if concept_right is not None else concept
    right = right_src.select(*[F.col(c).alias(c + "_2") for c in right_src.columns])
    mid = concept_relationship.select(F.col("concept_id_1").alias("ci_1"),
                                      F.col("relationship_id").alias("relationship"),
                                      F.col("concept_id_2").alias("ci_2"))
    out = left.join(mid, left["concept_id_1"] == mid["ci_1"], "left")
    return out.join(right, out["ci_2"] == right["concept_id_2"], "left")


# Local ICD edition -> OMOP vocabulary id.
ICD_VOCABULARY = {"CIE10ES": "ICD10CM", "CIE9MC": "ICD9CM"}
# A crosswalk with no more entries for any code is joined as it is.
FEW_ENTRIES = 32
# Entries that a row meets at once, result rows of a task and the number of tasks at which these grow instead.
ENTRIES_PER_BLOCK = 32_768
ROWS_PER_TASK = 20_000_000
MOST_TASKS = 5_000


def icd_expand(df: DataFrame, code_column: str, crosswalk: DataFrame,
               local_code: str = "CODIGO_PATOLOGIA", icd_code: str = "COD_CIE_NORMALIZADO",
               icd_type: str = "TIPO_CIE") -> DataFrame:
    """Local diagnosis code -> its ICD codes and OMOP vocabulary.

    One output row per (row, crosswalk match); columns ``icd_code`` and
    ``icd_vocabulary_id`` are null when the code has no crosswalk entry.
    Where a code has many entries the result is far larger than both
    sides. The entries then lie in blocks of at most ``ENTRIES_PER_BLOCK``,
    by vocabulary, a row meets each block once, and these pairs are dealt evenly to as
    many tasks as the result's rows need. So a task holds a block's rows
    at a time, whatever a code's share of the rows or of the entries.
    """
    cw = crosswalk.select(F.col(local_code).alias("_lc"), F.col(icd_code).alias("icd_code"),
                          literal_lookup(crosswalk, icd_type, ICD_VOCABULARY).alias("icd_vocabulary_id"))
    sizes = cw.filter(F.col("_lc").isNotNull()).groupBy("_lc").agg(F.count("*").alias("_n"))
    most, entries = sizes.agg(F.max("_n"), F.sum("_n")).first()
    if (most or 0) <= FEW_ENTRIES:
        return df.join(cw, df[code_column] == cw["_lc"], "left").drop("_lc")
    sized = df.join(broadcast_if_small(sizes), df[code_column] == sizes["_lc"], "left")
    rows = sized.agg(F.sum(F.coalesce("_n", F.lit(1)))).first()[0] or 0
    per_task = max(ROWS_PER_TASK, -(-rows // MOST_TASKS))
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
    last = F.floor((F.col("_n") - 1) / ENTRIES_PER_BLOCK)
    pairs = sized.withColumn("_b", F.explode_outer(F.sequence(F.lit(0).cast("long"), last))).drop("_n")
    # equal entries are alike, so the order is total as far as the result goes
    place = F.row_number().over(Window.partitionBy("_lc").orderBy("icd_code", "icd_vocabulary_id"))
    held = F.collect_list(F.struct("icd_code"))["icd_code"]  # of structs, as it would leave out nulls
    blocks = (cw.filter(F.col("_lc").isNotNull()).withColumn("_b", F.floor((place - 1) / ENTRIES_PER_BLOCK))
              .groupBy("_lc", "_b", "icd_vocabulary_id").agg(held.alias("_codes"))
              .groupBy("_lc", "_b").agg(F.collect_list(F.struct("icd_vocabulary_id", "_codes")).alias("_entries"),
                                        F.sum(F.size("_codes")).alias("_size")))
    on = ["_lc", "_b"]
    if entries <= DEFAULT_BROADCAST_ROWS:
        pairs, blocks = pairs.repartition(tasks), F.broadcast(blocks.drop("_size"))
    else:
        # a block is there once for every ``per_task`` of its result rows, and a pair goes to one of these slices
        on = [*on, "_s"]
        met = pairs.filter("_lc IS NOT NULL").groupBy("_lc", "_b").agg(F.count("*").alias("_r"))
        slices = F.ceil(F.col("_r") * F.col("_size") / per_task)
        blocks = blocks.join(met, ["_lc", "_b"]).withColumn("_k", slices).drop("_r", "_size")
        of = blocks.select("_lc", "_b", "_k")
        flat = [c for c, kind in df.dtypes if "map<" not in kind]
        pairs = (lookup_join(pairs, of.withColumnsRenamed({"_lc": "_l", "_b": "_i"}), [("_lc", "_l"), ("_b", "_i")])
                 .withColumn("_s", F.pmod(F.xxhash64(*flat), F.coalesce("_k", F.lit(tasks)))).drop("_k").repartition(tasks, *on))
        blocks = blocks.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).drop("_k")
    # a pair's few vocabularies first: what is then made a row at a time is one text, not a struct of two
    out = pairs.join(blocks, on, "left").drop(*on).select("*", F.inline_outer("_entries")).drop("_entries")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.explode_outer("_codes").alias("icd_code"), "icd_vocabulary_id")
