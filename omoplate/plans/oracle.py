"""Independent SQL formulations of the registered queries (DuckDB dialect).

They state each operator's definition directly (an ordered recursive scan
for overlap removal, islands for periods, a plain range join for visits)
so that the Spark plans are checked against a different derivation.
"""

from __future__ import annotations

from omoplate import catalogue

N_DAYS = 90

IV = """SELECT o.o_custkey AS person_id, l.l_shipdate AS start_date,
    l.l_shipdate + to_days(CAST(CAST(l.l_quantity AS BIGINT) % 30 AS INTEGER)) AS end_date,
    CAST(l.l_linenumber AS BIGINT) AS type_concept,
    l.l_linenumber, l.l_orderkey, l.l_partkey, l.l_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

IV_ORDER = ("start_date ASC NULLS LAST, end_date DESC NULLS LAST, l_linenumber ASC NULLS LAST, "
            "l_orderkey ASC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST")
IV_OUT = "person_id, start_date, end_date, type_concept, l_orderkey, l_partkey, l_suppkey"

VISITS = """SELECT event_id AS visit_occurrence_id, user_id AS person_id, ts AS visit_start_datetime,
    ts + to_hours(CAST(event_id % 72 AS INTEGER)) AS visit_end_datetime
  FROM events WHERE event_type = 'view'"""


def scan_ctes(src: str, order: str, p: str) -> str:
    """Row-by-row overlap removal: each row against the last kept row."""
    return f"""
{p}_ord AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY {order}) AS _rn,
    COALESCE(end_date <= start_date + INTERVAL 1 DAY, FALSE) AS _short FROM {src}),
{p}_scan AS (
  SELECT person_id, _rn, start_date AS _ks, end_date AS _ke, _short AS _kshort, TRUE AS _keep
  FROM {p}_ord WHERE _rn = 1
  UNION ALL
  SELECT person_id, _rn,
    CASE WHEN _d THEN _ks ELSE start_date END, CASE WHEN _d THEN _ke ELSE end_date END,
    CASE WHEN _d THEN _kshort ELSE _short END, NOT _d
  FROM (SELECT o.person_id, o._rn, o.start_date, o.end_date, o._short, s._ks, s._ke, s._kshort,
          COALESCE(o.start_date >= s._ks AND o.end_date <= s._ke AND NOT (o._short AND s._kshort), FALSE) AS _d
        FROM {p}_scan s JOIN {p}_ord o ON o.person_id = s.person_id AND o._rn = s._rn + 1) t),
{p}_kept AS (
  SELECT o.* EXCLUDE (_rn, _short) FROM {p}_ord o JOIN {p}_scan s ON o.person_id = s.person_id AND o._rn = s._rn
  WHERE s._keep
  UNION ALL SELECT o.* EXCLUDE (_rn, _short) FROM {p}_ord o WHERE o.person_id IS NULL)"""


def period_ctes(src: str, n_days: int, p: str) -> str:
    """Gaps and islands: a new period when the gap to the previous end is >= n days."""
    return f"""
{p}_g AS (SELECT *, row_number() OVER w AS _rn2,
    CASE WHEN person_id IS NULL OR row_number() OVER w = 1 THEN 1
         WHEN start_date >= lag(end_date) OVER w + to_days({n_days}) THEN 1 ELSE 0 END AS _brk
  FROM {src} WINDOW w AS (PARTITION BY person_id ORDER BY start_date ASC NULLS LAST, end_date DESC NULLS LAST)),
{p}_p AS (SELECT *, SUM(_brk) OVER (PARTITION BY person_id ORDER BY _rn2 ROWS UNBOUNDED PRECEDING) AS _period
  FROM {p}_g),
{p}_m AS (SELECT person_id, _period, type_concept,
    row_number() OVER (PARTITION BY person_id, _period ORDER BY COUNT(*) DESC, type_concept ASC) AS _mrk
  FROM {p}_p WHERE type_concept IS NOT NULL GROUP BY person_id, _period, type_concept),
{p}_out AS (SELECT a.person_id, a.start_date, a.end_date, m.type_concept
  FROM (SELECT person_id, _period, MIN(start_date) AS start_date, arg_max(end_date, _rn2) AS end_date
        FROM {p}_p GROUP BY person_id, _period) a
  LEFT JOIN {p}_m m ON a.person_id IS NOT DISTINCT FROM m.person_id AND a._period = m._period AND m._mrk = 1)"""


OBSERVATION_PERIOD = f"""WITH RECURSIVE
src AS (SELECT DISTINCT person_id, start_date, end_date, type_concept FROM ({IV}) x
        WHERE start_date IS NOT NULL AND end_date IS NOT NULL),
{scan_ctes('src', 'start_date ASC NULLS LAST, end_date DESC NULLS LAST, type_concept ASC NULLS LAST', 'w2')},
{period_ctes('w2_kept', N_DAYS, 'w4')}
SELECT CAST(row_number() OVER (ORDER BY person_id ASC NULLS LAST, start_date ASC NULLS LAST,
         end_date ASC NULLS LAST, type_concept ASC NULLS LAST) - 1 AS BIGINT) AS observation_period_id,
       CAST(person_id AS BIGINT) AS person_id,
       CAST(start_date AS DATE) AS observation_period_start_date,
       CAST(end_date AS DATE) AS observation_period_end_date,
       CAST(type_concept AS BIGINT) AS period_type_concept_id
FROM w4_out"""

OVERLAP_FLAG = f"""WITH iv AS ({IV}),
w AS (SELECT *, lag(start_date) OVER win AS _ps, lag(end_date) OVER win AS _pe,
        COALESCE(end_date <= start_date + INTERVAL 1 DAY, FALSE) AS _s,
        lag(COALESCE(end_date <= start_date + INTERVAL 1 DAY, FALSE)) OVER win AS _pshort
      FROM iv WINDOW win AS (PARTITION BY person_id ORDER BY {IV_ORDER}))
SELECT {IV_OUT},
  COALESCE(person_id IS NOT NULL AND start_date >= _ps AND end_date <= _pe
           AND NOT (_s AND COALESCE(_pshort, FALSE)), FALSE) AS is_contained
FROM w"""

REMOVE_OVERLAP = f"""WITH RECURSIVE iv AS ({IV}),
{scan_ctes('iv', IV_ORDER, 'w2')}
SELECT {IV_OUT} FROM w2_kept"""

GROUP_DATES = f"""WITH iv AS ({IV}),
{period_ctes('iv', N_DAYS, 'w4')}
SELECT person_id, start_date, end_date, type_concept FROM w4_out"""

PERSON_ROW_FLAGS = f"""WITH iv AS ({IV}),
r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY {IV_ORDER}) AS _rn,
        COUNT(*) OVER (PARTITION BY person_id) AS _n FROM iv)
SELECT {IV_OUT},
  person_id IS NOT NULL AND _rn = 1 AND _n > 1 AS is_first,
  person_id IS NOT NULL AND _rn = _n AND _n > 1 AS is_last,
  person_id IS NULL OR _n = 1 AS is_only
FROM r"""

MELT_START_END = f"""WITH iv AS ({IV})
SELECT DISTINCT person_id, d AS start_date, d AS end_date, type_concept
FROM (SELECT person_id, start_date AS d, type_concept FROM iv
      UNION ALL SELECT person_id, end_date AS d, type_concept FROM iv) x
WHERE d IS NOT NULL"""

REMOVE_END_DATE = f"""WITH iv AS ({IV})
SELECT person_id, start_date, start_date AS end_date, type_concept, l_orderkey, l_partkey, l_suppkey FROM iv"""

VISIT_LOOKUP = f"""WITH v0 AS ({VISITS}),
v AS (SELECT person_id, date_trunc('millisecond', visit_start_datetime) AS vs,
        date_trunc('millisecond', visit_end_datetime) AS ve, MIN(visit_occurrence_id) AS vid
      FROM v0 GROUP BY 1, 2, 3 HAVING COUNT(*) = 1),
e AS (SELECT event_id, user_id AS person_id, ts AS start_date FROM events WHERE event_type <> 'view'),
m AS (SELECT e.event_id, v.vid, v.vs, v.ve,
        row_number() OVER (PARTITION BY e.event_id ORDER BY v.vs, v.ve, v.vid) AS rk
      FROM e JOIN v ON e.person_id = v.person_id
       AND date_trunc('millisecond', e.start_date) BETWEEN v.vs AND v.ve)
SELECT e.event_id, e.person_id, e.start_date, m.vid AS visit_occurrence_id,
       m.vs AS visit_start_datetime, m.ve AS visit_end_datetime
FROM e LEFT JOIN m ON e.event_id = m.event_id AND m.rk = 1"""

VISIT_CONCEPT = f"""WITH v AS ({VISITS})
SELECT visit_occurrence_id, person_id,
  CAST(CASE WHEN person_id = 7 THEN 9203
            WHEN CAST(visit_end_datetime AS DATE) - CAST(visit_start_datetime AS DATE) BETWEEN 1 AND 3 THEN 9201
            ELSE 9202 END AS BIGINT) AS visit_concept_id
FROM v"""

VISIT_OCCURRENCE = f"""WITH RECURSIVE v AS ({VISITS}),
g AS (SELECT person_id, visit_start_datetime AS start_date, visit_end_datetime AS end_date,
        CAST(32817 AS BIGINT) AS type_concept, CAST(NULL AS BIGINT) AS provider_id,
        CAST(CASE WHEN CAST(visit_end_datetime AS DATE) - CAST(visit_start_datetime AS DATE) BETWEEN 1 AND 3
                  THEN 9201 ELSE 9202 END AS BIGINT) AS visit_concept_id FROM v
      UNION ALL
      SELECT person_id, start_date, end_date, CAST(32810 AS BIGINT), CAST(NULL AS BIGINT), CAST(9203 AS BIGINT)
      FROM ({IV}) x),
src AS (SELECT DISTINCT *, CASE visit_concept_id WHEN 9201 THEN 0 WHEN 9203 THEN 1 WHEN 9202 THEN 2 END AS _visit_rank
        FROM g),
{scan_ctes('src', 'start_date ASC NULLS LAST, end_date DESC NULLS LAST, _visit_rank ASC NULLS LAST', 'w2')}
SELECT CAST(row_number() OVER (ORDER BY person_id ASC NULLS LAST, start_date ASC NULLS LAST,
         end_date DESC NULLS LAST, _visit_rank ASC NULLS LAST, type_concept ASC NULLS LAST,
         provider_id ASC NULLS LAST) - 1 AS BIGINT) AS visit_occurrence_id,
  CAST(person_id AS BIGINT) AS person_id, visit_concept_id,
  CAST(start_date AS DATE) AS visit_start_date, start_date AS visit_start_datetime,
  CAST(end_date AS DATE) AS visit_end_date, end_date AS visit_end_datetime,
  type_concept AS visit_type_concept_id, provider_id,
  CAST(NULL AS BIGINT) AS care_site_id, CAST(NULL AS VARCHAR) AS visit_source_value,
  CAST(NULL AS BIGINT) AS visit_source_concept_id, CAST(NULL AS BIGINT) AS admitted_from_concept_id,
  CAST(NULL AS VARCHAR) AS admitted_from_source_value, CAST(NULL AS BIGINT) AS discharged_to_concept_id,
  CAST(NULL AS VARCHAR) AS discharged_to_source_value, CAST(NULL AS BIGINT) AS preceding_visit_occurrence_id
FROM w2_kept"""

ORACLE_SQL: dict[str, str] = {
    "observation_period": OBSERVATION_PERIOD,
    "overlap_flag": OVERLAP_FLAG,
    "remove_overlap": REMOVE_OVERLAP,
    "group_dates": GROUP_DATES,
    "person_row_flags": PERSON_ROW_FLAGS,
    "melt_start_end": MELT_START_END,
    "remove_end_date": REMOVE_END_DATE,
    "visit_lookup": VISIT_LOOKUP,
    "visit_concept": VISIT_CONCEPT,
    "visit_occurrence": VISIT_OCCURRENCE,
}


# -- vocabulary -------------------------------------------------------------------

BRAND_NO = "CAST(substr(p_brand, 7) AS INTEGER)"
DATA = """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
    CASE WHEN l.l_linenumber <= 5 THEN p.p_brand
         ELSE 'Brand#' || CAST((l.l_partkey + l.l_suppkey) % 25 + 1 AS VARCHAR) END AS vocabulary_id,
    CASE WHEN l.l_linenumber % 2 = 1 THEN p.p_name ELSE 'C' || CAST(l.l_partkey AS VARCHAR) END AS source_value
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""
SV_LOOKUP = f"""SELECT p_brand AS mv,
    CASE WHEN {BRAND_NO} <= 15 THEN p_name ELSE 'C' || CAST(p_partkey AS VARCHAR) END AS mk,
    MAX(p_partkey) AS cid
  FROM part WHERE {BRAND_NO} <= 20 GROUP BY 1, 2"""
EDGES = """SELECT p_partkey AS c1, MAX(p_partkey - p_partkey % 3) AS c2 FROM part
  WHERE p_partkey % 2 = 0 GROUP BY 1"""
MAPPED = f"""SELECT d.*, CAST(s.cid AS BIGINT) AS source_concept_id, CAST(COALESCE(e.c2, 0) AS BIGINT) AS concept_id
  FROM ({DATA}) d
  LEFT JOIN ({SV_LOOKUP}) s ON d.vocabulary_id = s.mv AND d.source_value = s.mk
  LEFT JOIN ({EDGES}) e ON s.cid = e.c1"""

MAP_SOURCE_VALUE = f"""SELECT d.*, CAST(s.cid AS BIGINT) AS source_concept_id
  FROM ({DATA}) d LEFT JOIN ({SV_LOOKUP}) s ON d.vocabulary_id = s.mv AND d.source_value = s.mk"""

MAP_STANDARD = MAPPED


def _fb_lookup(brand: str, by: str) -> str:
    key = "p_name" if by == "concept_name" else "'C' || CAST(p_partkey AS VARCHAR)"
    return f"""SELECT k, c.cid AS fs, COALESCE(e.c2, 0) AS fc FROM
      (SELECT {key} AS k, MAX(p_partkey) AS cid FROM part WHERE p_brand = '{brand}' GROUP BY 1) c
      LEFT JOIN ({EDGES}) e ON c.cid = e.c1"""


FALLBACK_MAPPING = f"""WITH m AS ({MAPPED}),
f AS (SELECT m.*, m.concept_id IS NULL OR m.concept_id = 0 AS open_,
        a.fs AS fs0, COALESCE(a.fc, 0) AS fc0, b.fs AS fs1, COALESCE(b.fc, 0) AS fc1
      FROM m LEFT JOIN ({_fb_lookup('Brand#21', 'concept_name')}) a ON m.source_value = a.k
             LEFT JOIN ({_fb_lookup('Brand#22', 'concept_code')}) b ON m.source_value = b.k),
r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, source_value,
        CASE WHEN NOT open_ THEN vocabulary_id WHEN fc0 <> 0 THEN 'Brand#21' ELSE 'Brand#22' END AS vocabulary_id,
        CAST(CASE WHEN NOT open_ THEN source_concept_id WHEN fc0 <> 0 THEN fs0 ELSE fs1 END AS BIGINT)
          AS source_concept_id,
        CAST(CASE WHEN NOT open_ THEN concept_id WHEN fc0 <> 0 THEN fc0 ELSE fc1 END AS BIGINT) AS concept_id
      FROM f)
SELECT *, concept_id IS NULL OR concept_id = 0 AS still_unmapped FROM r"""

OVERRIDE_MAPPINGS = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, vocabulary_id, source_value,
    source_concept_id,
    CAST(CASE WHEN (concept_id IS NULL OR concept_id = 0) AND source_value IN ('red plate', 'small widget', 'C7')
         THEN CASE source_value WHEN 'red plate' THEN 1001 WHEN 'small widget' THEN 1002 ELSE 1003 END
         ELSE concept_id END AS BIGINT) AS concept_id
  FROM ({MAPPED}) m"""

UNMAPPED_VALUES = f"""SELECT DISTINCT source_value FROM ({MAPPED}) m WHERE concept_id IS NULL OR concept_id = 0"""

UNMAPPED_REPORT = f"""WITH m AS ({MAPPED})
SELECT DISTINCT source_value, source_concept_id, concept_id, vocabulary_id FROM m
WHERE source_value IN (SELECT source_value FROM m WHERE concept_id IS NULL OR concept_id = 0)"""

UNIT_MAPPING = f"""WITH d AS (SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey,
        p.p_name AS measurement_source_value FROM ({DATA}) x JOIN part p ON x.l_partkey = p.p_partkey),
u AS (SELECT 8000 + n_nationkey AS concept_id, lower(n_name) AS concept_name,
        'u' || CAST(n_nationkey AS VARCHAR) AS concept_code,
        CASE WHEN n_regionkey % 2 = 0 THEN 'UCUM' ELSE 'SNOMED' END AS vocabulary_id FROM nation),
clc AS (SELECT p_name AS k, MAX(CASE WHEN p_size % 2 = 0 THEN 'u' || CAST(p_partkey % 25 AS VARCHAR)
          ELSE 'nation_' || CAST(p_partkey % 25 AS VARCHAR) END) AS v FROM part GROUP BY 1),
ucum AS (SELECT concept_code AS k, MAX(concept_id) AS id FROM u WHERE vocabulary_id = 'UCUM' GROUP BY 1),
snomed AS (SELECT concept_name AS k, MAX(concept_id) AS id FROM u WHERE vocabulary_id = 'SNOMED' GROUP BY 1)
SELECT d.*, clc.v AS unit_source_value,
  CASE WHEN ucum.id IS NOT NULL THEN 'UCUM' ELSE 'SNOMED' END AS unit_vocabulary_id,
  CAST(COALESCE(ucum.id, snomed.id) AS BIGINT) AS unit_source_concept_id
FROM d LEFT JOIN clc ON d.measurement_source_value = clc.k
  LEFT JOIN ucum ON clc.v = ucum.k LEFT JOIN snomed ON clc.v = snomed.k"""

CONCEPT = """SELECT CAST(p_partkey AS BIGINT) AS concept_id, p_name AS concept_name, p_brand AS vocabulary_id,
    CASE WHEN p_partkey % 3 = 0 THEN 'S' END AS standard_concept FROM part"""
REL = """SELECT CAST(p_partkey AS BIGINT) AS concept_id_1,
    CASE WHEN p_partkey % 2 = 0 THEN 'Maps to' ELSE 'Is a' END AS relationship_id,
    CAST(p_partkey - p_partkey % 3 AS BIGINT) AS concept_id_2 FROM part"""

WIDE_RELATIONSHIP = f"""WITH c AS ({CONCEPT}), r AS ({REL})
SELECT a.concept_id AS concept_id_1, a.concept_name AS concept_name_1, a.vocabulary_id AS vocabulary_id_1,
  a.standard_concept AS standard_concept_1, r.concept_id_1 AS ci_1, r.relationship_id AS relationship,
  r.concept_id_2 AS ci_2, b.concept_id AS concept_id_2, b.concept_name AS concept_name_2,
  b.vocabulary_id AS vocabulary_id_2, b.standard_concept AS standard_concept_2
FROM c a LEFT JOIN r ON a.concept_id = r.concept_id_1 LEFT JOIN c b ON r.concept_id_2 = b.concept_id"""

ORACLE_SQL.update({
    "map_source_value": MAP_SOURCE_VALUE,
    "map_standard": MAP_STANDARD,
    "fallback_mapping": FALLBACK_MAPPING,
    "override_mappings": OVERRIDE_MAPPINGS,
    "unmapped_values": UNMAPPED_VALUES,
    "unmapped_report": UNMAPPED_REPORT,
    "unit_mapping": UNIT_MAPPING,
    "wide_relationship": WIDE_RELATIONSHIP,
})


# -- clinical event tables ---------------------------------------------------------

REC = """SELECT o.o_custkey AS person_id, l.l_shipdate AS start_date,
    l.l_shipdate + to_days(CAST(CAST(l.l_quantity AS BIGINT) % 30 AS INTEGER)) AS end_date,
    CAST(32817 AS BIGINT) AS type_concept,
    CASE WHEN l.l_linenumber <= 5 THEN p.p_brand
         ELSE 'Brand#' || CAST((l.l_partkey + l.l_suppkey) % 25 + 1 AS VARCHAR) END AS vocabulary_id,
    CASE WHEN l.l_linenumber % 2 = 1 THEN p.p_name ELSE 'C' || CAST(l.l_partkey AS VARCHAR) END AS source_value,
    l.l_linenumber, l.l_quantity, l.l_partkey
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""

ORDER_VISITS = """SELECT person_id, vs, ve, MIN(vid) AS vid FROM (
    SELECT o_custkey AS person_id, date_trunc('millisecond', o_orderdate) AS vs,
      date_trunc('millisecond', o_orderdate + to_days(CAST(o_orderkey % 20 AS INTEGER))) AS ve,
      o_orderkey AS vid FROM orders) x
  GROUP BY 1, 2, 3 HAVING COUNT(*) = 1"""


def link_ctes(src: str, id_col: str, p: str) -> str:
    return f"""
{p}_v AS ({ORDER_VISITS}),
{p}_m AS (SELECT e.{id_col} AS _eid, v.vid, row_number() OVER (PARTITION BY e.{id_col} ORDER BY v.vs, v.ve, v.vid) AS _rk
  FROM {src} e JOIN {p}_v v ON e.person_id = v.person_id
   AND date_trunc('millisecond', e.start_date) BETWEEN v.vs AND v.ve),
{p}_out AS (SELECT s.*, CAST(m.vid AS BIGINT) AS visit_occurrence_id FROM {src} s
  LEFT JOIN {p}_m m ON s.{id_col} = m._eid AND m._rk = 1)"""


def _nl(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS LAST" for c in cols.split(","))


_CONDITION_MAPPED = f"""WITH r AS ({REC}),
m AS (SELECT r.person_id, r.start_date, r.end_date, r.type_concept, r.source_value AS condition_source_value,
        r.vocabulary_id, CAST(s.cid AS BIGINT) AS src, CAST(COALESCE(e.c2, 0) AS BIGINT) AS std
      FROM r LEFT JOIN ({SV_LOOKUP}) s ON r.vocabulary_id = s.mv AND r.source_value = s.mk
      LEFT JOIN ({EDGES}) e ON s.cid = e.c1),
f AS (SELECT m.*, m.std = 0 AS open_, a.fs AS fs0, COALESCE(a.fc, 0) AS fc0, b.fs AS fs1, COALESCE(b.fc, 0) AS fc1
      FROM m LEFT JOIN ({_fb_lookup('Brand#21', 'concept_name')}) a ON m.condition_source_value = a.k
             LEFT JOIN ({_fb_lookup('Brand#22', 'concept_code')}) b ON m.condition_source_value = b.k),
g AS (SELECT person_id, start_date, end_date, type_concept, condition_source_value,
        CASE WHEN NOT open_ THEN vocabulary_id WHEN fc0 <> 0 THEN 'Brand#21' ELSE 'Brand#22' END AS vocabulary_id,
        CAST(CASE WHEN NOT open_ THEN src WHEN fc0 <> 0 THEN fs0 ELSE fs1 END AS BIGINT) AS condition_source_concept_id,
        CAST(CASE WHEN NOT open_ THEN std WHEN fc0 <> 0 THEN fc0 ELSE fc1 END AS BIGINT) AS condition_concept_id
      FROM f)"""

CONDITION = f"""{_CONDITION_MAPPED},
k AS (SELECT *, CAST(row_number() OVER (ORDER BY {_nl('person_id, start_date, end_date, condition_source_value, vocabulary_id, type_concept, condition_source_concept_id, condition_concept_id')}) - 1 AS BIGINT) AS condition_occurrence_id FROM g),
{link_ctes('k', 'condition_occurrence_id', 'lk')}
SELECT condition_occurrence_id, CAST(person_id AS BIGINT) AS person_id, condition_concept_id,
  CAST(start_date AS DATE) AS condition_start_date, start_date AS condition_start_datetime,
  CAST(end_date AS DATE) AS condition_end_date, end_date AS condition_end_datetime,
  type_concept AS condition_type_concept_id, CAST(NULL AS BIGINT) AS condition_status_concept_id,
  CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS BIGINT) AS provider_id, visit_occurrence_id,
  CAST(NULL AS BIGINT) AS visit_detail_id, condition_source_value, condition_source_concept_id,
  CAST(NULL AS VARCHAR) AS condition_status_source_value
FROM lk_out"""

DRUG = f"""WITH r AS ({REC}),
m AS (SELECT r.person_id, r.start_date, r.end_date, r.type_concept, r.source_value AS drug_source_value,
        r.vocabulary_id, CAST(s.cid AS BIGINT) AS drug_source_concept_id,
        CAST(COALESCE(e.c2, 0) AS BIGINT) AS std
      FROM r LEFT JOIN ({SV_LOOKUP}) s ON r.vocabulary_id = s.mv AND r.source_value = s.mk
      LEFT JOIN ({EDGES}) e ON s.cid = e.c1),
g AS (SELECT * EXCLUDE (std), CAST(CASE WHEN std = 0 AND drug_source_value = 'red plate' THEN 99
        WHEN std = 0 AND drug_source_value = 'C8' THEN 12 ELSE std END AS BIGINT) AS drug_concept_id FROM m),
k AS (SELECT *, CAST(row_number() OVER (ORDER BY {_nl('person_id, start_date, end_date, drug_source_value, vocabulary_id, type_concept, drug_source_concept_id, drug_concept_id')}) - 1 AS BIGINT) AS drug_exposure_id FROM g),
{link_ctes('k', 'drug_exposure_id', 'lk')}
SELECT drug_exposure_id, CAST(person_id AS BIGINT) AS person_id, drug_concept_id,
  CAST(start_date AS DATE) AS drug_exposure_start_date, start_date AS drug_exposure_start_datetime,
  CAST(end_date AS DATE) AS drug_exposure_end_date, end_date AS drug_exposure_end_datetime,
  CAST(NULL AS DATE) AS verbatim_end_date, type_concept AS drug_type_concept_id,
  CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS BIGINT) AS refills, CAST(NULL AS DOUBLE) AS quantity,
  CAST(NULL AS BIGINT) AS days_supply, CAST(NULL AS VARCHAR) AS sig, CAST(NULL AS BIGINT) AS route_concept_id,
  CAST(NULL AS VARCHAR) AS lot_number, CAST(NULL AS BIGINT) AS provider_id, visit_occurrence_id,
  CAST(NULL AS BIGINT) AS visit_detail_id, drug_source_value, drug_source_concept_id,
  CAST(NULL AS VARCHAR) AS route_source_value, CAST(NULL AS VARCHAR) AS dose_unit_source_value
FROM lk_out"""

MEASUREMENT = f"""WITH r AS ({REC}),
d AS (SELECT r.person_id, r.start_date, r.end_date, r.type_concept, r.vocabulary_id,
        r.source_value AS measurement_source_value, CAST(r.l_quantity AS VARCHAR) AS value_source_value,
        CAST(NULL AS VARCHAR) AS value_vocabulary_id, TRUE AS is_values FROM r WHERE r.l_linenumber <= 4
      UNION ALL
      SELECT r.person_id, r.start_date, r.end_date, r.type_concept, r.vocabulary_id,
        r.source_value, p.p_name, p.p_brand, FALSE FROM r JOIN part p ON r.l_partkey = p.p_partkey
      WHERE r.l_linenumber > 4),
u AS (SELECT 8000 + n_nationkey AS concept_id, lower(n_name) AS concept_name,
        'u' || CAST(n_nationkey AS VARCHAR) AS concept_code,
        CASE WHEN n_regionkey % 2 = 0 THEN 'UCUM' ELSE 'SNOMED' END AS vocabulary_id FROM nation),
clc AS (SELECT p_name AS k, MAX(CASE WHEN p_size % 2 = 0 THEN 'u' || CAST(p_partkey % 25 AS VARCHAR)
          ELSE 'nation_' || CAST(p_partkey % 25 AS VARCHAR) END) AS v FROM part GROUP BY 1),
ucum AS (SELECT concept_code AS k, MAX(concept_id) AS id FROM u WHERE vocabulary_id = 'UCUM' GROUP BY 1),
snomed AS (SELECT concept_name AS k, MAX(concept_id) AS id FROM u WHERE vocabulary_id = 'SNOMED' GROUP BY 1),
e AS ({EDGES}), s AS ({SV_LOOKUP}),
m AS (SELECT d.*, CAST(s1.cid AS BIGINT) AS measurement_source_concept_id,
        CASE WHEN d.is_values THEN CAST(d.value_source_value AS DOUBLE) END AS value_as_number,
        CAST(CASE WHEN NOT d.is_values THEN s2.cid END AS BIGINT) AS value_source_concept_id,
        clc.v AS unit_source_value, CAST(COALESCE(ucum.id, snomed.id) AS BIGINT) AS unit_source_concept_id
      FROM d LEFT JOIN s s1 ON d.vocabulary_id = s1.mv AND d.measurement_source_value = s1.mk
      LEFT JOIN s s2 ON d.value_vocabulary_id = s2.mv AND d.value_source_value = s2.mk
      LEFT JOIN clc ON d.measurement_source_value = clc.k
      LEFT JOIN ucum ON clc.v = ucum.k LEFT JOIN snomed ON clc.v = snomed.k),
n AS (SELECT m.*, COALESCE(e1.c2, 0) AS mc, COALESCE(e2.c2, 0) AS uc, COALESCE(e3.c2, 0) AS vc,
        TRY_CAST(m.value_source_value AS DOUBLE) IS NOT NULL AS numeric_
      FROM m LEFT JOIN e e1 ON m.measurement_source_concept_id = e1.c1
      LEFT JOIN e e2 ON m.unit_source_concept_id = e2.c1 LEFT JOIN e e3 ON m.value_source_concept_id = e3.c1),
o AS (SELECT n.*,
        CAST(CASE WHEN mc = 0 AND measurement_source_value = 'hot ring' THEN 198 ELSE mc END AS BIGINT)
          AS measurement_concept_id,
        CAST(CASE WHEN (NOT numeric_ OR uc = 0) AND unit_source_value = 'u3' THEN 8003
                  WHEN numeric_ THEN uc END AS BIGINT) AS unit_concept_id,
        CAST(CASE WHEN NOT numeric_ THEN vc END AS BIGINT) AS value_as_concept_id FROM n),
k AS (SELECT *, CAST(row_number() OVER (ORDER BY {_nl('person_id, start_date, end_date, measurement_source_value, vocabulary_id, value_source_value, value_vocabulary_id, type_concept')}) - 1 AS BIGINT) AS measurement_id FROM o),
{link_ctes('k', 'measurement_id', 'lk')}
SELECT measurement_id, CAST(person_id AS BIGINT) AS person_id, measurement_concept_id,
  CAST(start_date AS DATE) AS measurement_date, CAST(NULL AS TIMESTAMP) AS measurement_datetime,
  CAST(NULL AS VARCHAR) AS measurement_time, type_concept AS measurement_type_concept_id,
  CAST(NULL AS BIGINT) AS operator_concept_id, value_as_number, value_as_concept_id, unit_concept_id,
  CAST(NULL AS DOUBLE) AS range_low, CAST(NULL AS DOUBLE) AS range_high, CAST(NULL AS BIGINT) AS provider_id,
  visit_occurrence_id, CAST(NULL AS BIGINT) AS visit_detail_id, measurement_source_value,
  measurement_source_concept_id, unit_source_value, unit_source_concept_id, value_source_value,
  CAST(NULL AS BIGINT) AS measurement_event_id, CAST(NULL AS BIGINT) AS meas_event_field_concept_id
FROM lk_out"""

ORACLE_SQL.update({"condition": CONDITION, "drug": DRUG, "measurement": MEASUREMENT})


# -- dimensions -------------------------------------------------------------------

LOCATION_ROWS = """SELECT DISTINCT CAST(c.c_custkey + 100 AS BIGINT) AS location_id,
    'Street of ' || c.c_name AS address_1, '' AS address_2,
    n.n_name AS city, r.r_name AS state, CAST(n.n_nationkey AS VARCHAR) AS zip, r.r_name AS county,
    c.c_name AS location_source_value, CAST(4330442 AS BIGINT) AS country_concept_id,
    'ES' AS country_source_value, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""

LOCATION = LOCATION_ROWS

PERSON = f"""WITH c AS (SELECT *, TIMESTAMP '1940-01-01' + to_days(CAST((c_custkey * 37) % 25000 AS INTEGER)) AS b
              FROM customer),
loc AS (SELECT zip, MAX(location_id) AS location_id FROM ({LOCATION_ROWS}) x GROUP BY zip)
SELECT CAST(c.c_custkey AS BIGINT) AS person_id,
  CAST(CASE WHEN c.c_custkey % 2 = 0 THEN 8532 ELSE 8507 END AS BIGINT) AS gender_concept_id,
  CAST(year(c.b) AS BIGINT) AS year_of_birth, CAST(month(c.b) AS BIGINT) AS month_of_birth,
  CAST(day(c.b) AS BIGINT) AS day_of_birth, c.b AS birth_datetime,
  CAST(0 AS BIGINT) AS race_concept_id, CAST(0 AS BIGINT) AS ethnicity_concept_id,
  CAST(loc.location_id AS BIGINT) AS location_id, CAST(NULL AS BIGINT) AS provider_id,
  CAST(NULL AS BIGINT) AS care_site_id, CAST(NULL AS VARCHAR) AS person_source_value,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'Mujer' ELSE 'Hombre' END AS gender_source_value,
  CAST(NULL AS BIGINT) AS gender_source_concept_id, CAST(NULL AS VARCHAR) AS race_source_value,
  CAST(NULL AS BIGINT) AS race_source_concept_id, CAST(NULL AS VARCHAR) AS ethnicity_source_value,
  CAST(NULL AS BIGINT) AS ethnicity_source_concept_id
FROM c LEFT JOIN loc ON CAST(c.c_nationkey AS VARCHAR) = loc.zip"""

PROVIDER = """WITH s AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS provider_source_value, s_name AS provider_name,
        'spec_' || CAST(s_nationkey % 7 AS VARCHAR) AS specialty_source_value FROM supplier),
m AS (SELECT *, CASE specialty_source_value WHEN 'spec_0' THEN 38004451 WHEN 'spec_1' THEN 38004477
        WHEN 'spec_2' THEN 38003902 WHEN 'spec_3' THEN 38004455 WHEN 'spec_5' THEN 38004446
        WHEN 'spec_6' THEN 0 END AS specialty_concept_id FROM s)
SELECT CAST(row_number() OVER (ORDER BY provider_source_value ASC NULLS LAST, provider_name ASC NULLS LAST,
         specialty_source_value ASC NULLS LAST) - 1 AS BIGINT) AS provider_id,
  provider_name, CAST(NULL AS VARCHAR) AS npi, CAST(NULL AS VARCHAR) AS dea,
  CAST(specialty_concept_id AS BIGINT) AS specialty_concept_id, CAST(NULL AS BIGINT) AS care_site_id,
  CAST(NULL AS BIGINT) AS year_of_birth, CAST(NULL AS BIGINT) AS gender_concept_id, provider_source_value,
  specialty_source_value, CAST(NULL AS BIGINT) AS specialty_source_concept_id,
  CAST(NULL AS VARCHAR) AS gender_source_value, CAST(NULL AS BIGINT) AS gender_source_concept_id
FROM m"""

DEATH = """SELECT CAST(c.c_custkey AS BIGINT) AS person_id, CAST(d.dd AS DATE) AS death_date,
  CAST(NULL AS TIMESTAMP) AS death_datetime, CAST(32817 AS BIGINT) AS death_type_concept_id,
  CAST(NULL AS BIGINT) AS cause_concept_id, CAST(NULL AS VARCHAR) AS cause_source_value,
  CAST(NULL AS BIGINT) AS cause_source_concept_id
FROM customer c JOIN (SELECT o_custkey, MAX(o_orderdate) AS dd FROM orders WHERE o_orderstatus = 'F'
                      GROUP BY 1) d ON c.c_custkey = d.o_custkey"""

COHORT = """SELECT CAST(1 AS BIGINT) AS cohort_definition_id, CAST(c_custkey AS BIGINT) AS subject_id,
    DATE '2017-01-01' AS cohort_start_date, DATE '2023-12-01' AS cohort_end_date
  FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') a
UNION ALL
SELECT CAST(2 AS BIGINT), CAST(c_custkey AS BIGINT), DATE '2018-01-01', DATE '2023-12-01'
  FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') b"""

CDM_SOURCE = """SELECT 'omoplate' AS cdm_source_name, 'omoplate' AS cdm_source_abbreviation, 'Example holder' AS cdm_holder,
  'OMOP instance built from the benchmark tables' AS source_description,
  CAST(NULL AS VARCHAR) AS source_documentation_reference, 'etl-7' AS cdm_etl_reference,
  CAST(MAX(o_orderdate) AS DATE) AS source_release_date, DATE '2024-03-04' AS cdm_release_date,
  '5.4' AS cdm_version, CAST(756265 AS BIGINT) AS cdm_version_concept_id, 'vocabulary-3' AS vocabulary_version
FROM orders"""

STANDARDISE = """SELECT CAST(o_custkey AS BIGINT) AS person_id, o_orderdate AS start_date,
  o_orderdate + to_days(CAST(o_orderkey % 20 AS INTEGER)) AS end_date, CAST(32817 AS BIGINT) AS type_concept,
  'AN' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS person_source_value,
  o_orderkey, o_orderstatus, o_totalprice
FROM orders"""

ORACLE_SQL.update({"location": LOCATION, "person": PERSON, "provider": PROVIDER, "death": DEATH,
                   "cohort": COHORT, "cdm_source": CDM_SOURCE, "standardise": STANDARDISE})


# -- ingest, text, integrity checks ------------------------------------------------

CSV_INGEST = """SELECT 'AN' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS NUHSA,
  CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS fec_pedido, o_orderpriority
FROM orders"""

ICD_EXPAND = f"""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        'P' || CAST(l_partkey % 700 AS VARCHAR) AS pathology_code FROM ({DATA}) x),
cw AS (SELECT 'P' || CAST(p_partkey % 500 AS VARCHAR) AS k,
        upper(substr(p_name, 1, 1)) || CAST(p_size AS VARCHAR) AS icd_code,
        CASE WHEN p_size % 2 = 0 THEN 'ICD10CM' ELSE 'ICD9CM' END AS icd_vocabulary_id FROM part)
SELECT d.*, cw.icd_code, cw.icd_vocabulary_id FROM d LEFT JOIN cw ON d.pathology_code = cw.k"""

PK_CHECK = """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"""


def _fk(table: str, child: str, column: str, parent: str, pcol: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", CAST(v AS VARCHAR) AS value, CAST(n AS BIGINT) AS n
  FROM (SELECT {column} AS v, COUNT(*) AS n FROM {child} WHERE {column} IS NOT NULL GROUP BY 1) c
  WHERE v NOT IN (SELECT {pcol} FROM {parent} WHERE {pcol} IS NOT NULL)"""


FK_CHECK = " UNION ALL ".join([
    _fk("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _fk("lineitem", "lineitem", "l_partkey", "part", "p_partkey"),
    _fk("lineitem", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _fk("orders", "orders", "o_custkey", "customer", "c_custkey"),
    _fk("events", "events", "user_id", "customer", "c_custkey"),
    _fk("events", "events", "event_id", f"({VISITS}) v", "visit_occurrence_id"),
    _fk("PERSON", f"({PERSON}) p", "location_id", f"({LOCATION}) l", "location_id"),
])

NULL_CHECK = """UNPIVOT (SELECT COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS l_orderkey,
    COUNT(*) FILTER (WHERE l_partkey IS NULL) AS l_partkey, COUNT(*) FILTER (WHERE l_suppkey IS NULL) AS l_suppkey,
    COUNT(*) FILTER (WHERE l_linenumber IS NULL) AS l_linenumber,
    COUNT(*) FILTER (WHERE l_quantity IS NULL) AS l_quantity,
    COUNT(*) FILTER (WHERE l_extendedprice IS NULL) AS l_extendedprice,
    COUNT(*) FILTER (WHERE l_discount IS NULL) AS l_discount, COUNT(*) FILTER (WHERE l_tax IS NULL) AS l_tax,
    COUNT(*) FILTER (WHERE l_returnflag IS NULL) AS l_returnflag,
    COUNT(*) FILTER (WHERE l_linestatus IS NULL) AS l_linestatus,
    COUNT(*) FILTER (WHERE l_shipdate IS NULL) AS l_shipdate FROM lineitem)
  ON COLUMNS(*) INTO NAME "column" VALUE n_null"""

LENGTH_CHECK = """SELECT 'p_name' AS "column", CAST(10 AS BIGINT) AS max_length,
    COUNT(*) FILTER (WHERE length(p_name) > 10) AS n_too_long FROM part
  UNION ALL SELECT 'p_type', 6, COUNT(*) FILTER (WHERE length(p_type) > 6) FROM part
  UNION ALL SELECT 'p_brand', 7, COUNT(*) FILTER (WHERE length(p_brand) > 7) FROM part"""

DATE_RULES = f"""WITH ev AS (SELECT r.person_id, r.start_date, r.end_date, p.birth_datetime AS birth,
        CAST(d.death_date AS TIMESTAMP) AS death
      FROM ({REC}) r LEFT JOIN ({PERSON}) p ON r.person_id = p.person_id
      LEFT JOIN (SELECT person_id, MIN(death_date) AS death_date FROM ({DEATH}) x GROUP BY 1) d
        ON r.person_id = d.person_id),
a AS (SELECT COUNT(*) FILTER (WHERE start_date IS NULL) AS start_missing,
        COUNT(*) FILTER (WHERE end_date < start_date) AS end_before_start,
        COUNT(*) FILTER (WHERE start_date < birth) AS start_before_birth,
        COUNT(*) FILTER (WHERE start_date > death) AS start_after_death,
        COUNT(*) FILTER (WHERE end_date > death + INTERVAL 60 DAY) AS end_after_death_grace FROM ev)
UNPIVOT a ON COLUMNS(*) INTO NAME "rule" VALUE n_violations"""

KEY_CHECK = f"""SELECT COUNT(*) AS n_rows, COUNT(provider_id) AS n_present, COUNT(DISTINCT provider_id) AS n_distinct,
  MIN(provider_id) AS min_key, MAX(provider_id) AS max_key,
  COUNT(provider_id) = COUNT(*) AND COUNT(DISTINCT provider_id) = COUNT(*)
    AND (COUNT(*) = 0 OR (MIN(provider_id) = 0 AND MAX(provider_id) = COUNT(*) - 1)) AS is_dense
FROM ({PROVIDER}) p"""

ORACLE_SQL.update({"csv_ingest": CSV_INGEST, "icd_expand": ICD_EXPAND, "pk_check": PK_CHECK,
                   "fk_check": FK_CHECK, "null_check": NULL_CHECK, "length_check": LENGTH_CHECK,
                   "date_rules": DATE_RULES, "key_check": KEY_CHECK})


PROCEDURE = """SELECT CAST(l_orderkey AS BIGINT) AS procedure_occurrence_id, CAST(l_suppkey * 3 AS BIGINT) AS person_id,
    CAST(l_partkey * 2 AS BIGINT) AS procedure_concept_id, CAST(l_shipdate AS DATE) AS procedure_date,
    CAST(NULL AS TIMESTAMP) AS procedure_datetime, CAST(l_shipdate AS DATE) - CAST(l_linenumber - 3 AS INTEGER) AS procedure_end_date,
    CAST(NULL AS TIMESTAMP) AS procedure_end_datetime, CAST(l_linenumber AS BIGINT) AS procedure_type_concept_id,
    CAST(NULL AS BIGINT) AS modifier_concept_id, CAST(NULL AS BIGINT) AS quantity, CAST(l_suppkey AS BIGINT) AS provider_id,
    CAST(CASE WHEN l_linenumber > 2 THEN l_linenumber + 40 END AS BIGINT) AS visit_occurrence_id,
    CAST(NULL AS BIGINT) AS visit_detail_id, CAST(NULL AS VARCHAR) AS procedure_source_value,
    CAST(NULL AS BIGINT) AS procedure_source_concept_id, CAST(NULL AS VARCHAR) AS modifier_source_value FROM lineitem"""
CARE_SITE = """SELECT CAST(n_nationkey AS BIGINT) AS care_site_id, n_name AS care_site_name,
    CAST(n_nationkey * 100 AS BIGINT) AS place_of_service_concept_id, CAST(n_nationkey * 7 AS BIGINT) AS location_id,
    repeat(n_name, 8) AS care_site_source_value, CAST(NULL AS VARCHAR) AS place_of_service_source_value FROM nation"""
ORACLE_SQL.update({"care_site": CARE_SITE, "procedure": PROCEDURE})

# The columns that the built tables have beyond their schema, or lack of it, are left to the schema; of the
# vocabulary these are there.
_BUILT = {"PERSON": PERSON, "LOCATION": LOCATION, "PROVIDER": PROVIDER, "DEATH": DEATH, "OBSERVATION_PERIOD": OBSERVATION_PERIOD,
          "VISIT_OCCURRENCE": VISIT_OCCURRENCE, "CONDITION_OCCURRENCE": CONDITION, "DRUG_EXPOSURE": DRUG, "MEASUREMENT": MEASUREMENT,
          "CONCEPT": """SELECT CAST(p_partkey AS BIGINT) AS concept_id, p_name AS concept_name, p_type AS domain_id,
                p_brand AS vocabulary_id, 'Clinical Finding' AS concept_class_id,
                CASE WHEN p_partkey % 3 = 0 THEN 'S' END AS standard_concept, 'C' || p_partkey AS concept_code FROM part""",
          "CONCEPT_RELATIONSHIP": """SELECT CAST(p_partkey AS BIGINT) AS concept_id_1,
                CASE WHEN p_partkey % 2 = 0 THEN 'Maps to' ELSE 'Is a' END AS relationship_id,
                CAST(p_partkey - p_partkey % 3 AS BIGINT) AS concept_id_2 FROM part""",
          "VOCABULARY": """SELECT p_brand AS vocabulary_id, 'The vocabulary ' || p_brand AS vocabulary_name,
                CAST(min(p_partkey) AS BIGINT) AS vocabulary_concept_id FROM part WHERE p_brand NOT LIKE '%5' GROUP BY p_brand""",
          "DOMAIN": """SELECT p_type AS domain_id, p_type AS domain_name, CAST(-max(p_partkey) AS BIGINT) AS domain_concept_id
                FROM part GROUP BY p_type""",
          "CARE_SITE": CARE_SITE, "PROCEDURE_OCCURRENCE": PROCEDURE}
_PARTIAL = {"CONCEPT": ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "standard_concept",
                        "concept_code"],
            "CONCEPT_RELATIONSHIP": ["concept_id_1", "relationship_id", "concept_id_2"],
            "VOCABULARY": ["vocabulary_id", "vocabulary_name", "vocabulary_concept_id"]}


def _violations(table: str) -> list[str]:
    """Every check of a table as a statement of its own."""
    names = _PARTIAL.get(table, catalogue.schema(table).names)
    head = lambda check, column, value: f"""SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column",
        CAST({value} AS VARCHAR) AS value"""  # noqa: E731
    some = lambda test: f"CAST(COUNT(*) AS BIGINT) AS n FROM t_{table} WHERE {test} HAVING COUNT(*) > 0"
    out = [f"{head('null', f.name, 'NULL')}, {some(f.name + ' IS NULL')}"
           for f in catalogue.schema(table) if not f.nullable and f.name in names]
    out += [f"{head('length', c, 'NULL')}, {some(f'length({c}) > {n}')}" for c, n in catalogue.text_lengths(table).items() if c in names]
    out += [f"""{head('pk', k, k)}, CAST(COUNT(*) AS BIGINT) AS n FROM t_{table} GROUP BY {k} HAVING COUNT(*) > 1"""
            for k in catalogue.primary_key(table)]
    out += [f"""{head('fk', c, 'v')}, CAST(n AS BIGINT) AS n FROM (SELECT {c} AS v, COUNT(*) AS n FROM t_{table} WHERE {c} IS NOT NULL
        GROUP BY 1) x WHERE v NOT IN (SELECT {pc} FROM t_{pt} WHERE {pc} IS NOT NULL)"""
            for t, c, pt, pc in catalogue.foreign_keys() if t == table and pt in _BUILT and c in names]
    span = catalogue.date_columns(table)
    if span:
        rules = {"start_missing": "s IS NULL", "end_before_start": "e < s", "start_before_birth": "s < p.birth_datetime",
                 "start_after_death": "s > d.death", "end_after_death_grace": "e > d.death + INTERVAL 60 DAY"}
        out += [f"""SELECT 'date', '{table}', '{rule}', CAST(NULL AS VARCHAR), CAST(COUNT(*) AS BIGINT)
            FROM (SELECT person_id, CAST({span[0]} AS TIMESTAMP) AS s, CAST({span[1]} AS TIMESTAMP) AS e FROM t_{table}) x
            LEFT JOIN t_PERSON p ON x.person_id = p.person_id
            LEFT JOIN (SELECT person_id, CAST(MIN(death_date) AS TIMESTAMP) AS death FROM t_DEATH GROUP BY 1) d
              ON x.person_id = d.person_id WHERE {test} HAVING COUNT(*) > 0""" for rule, test in rules.items()]
    return out


CDM_CONSTRAINTS = ("WITH " + ", ".join(f"t_{t} AS MATERIALIZED ({sql})" for t, sql in _BUILT.items()) + " "
                   + " UNION ALL ".join(q for t in _BUILT for q in _violations(t)))

ORACLE_SQL["cdm_constraints"] = CDM_CONSTRAINTS


SHIPMENT_VISIT_LOOKUP = f"""WITH e AS (SELECT CAST(o.o_custkey AS BIGINT) AS person_id, l.l_shipdate AS start_date,
        l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
v AS ({ORDER_VISITS}),
m AS (SELECT e.l_orderkey, e.l_linenumber, e.l_partkey, e.l_suppkey, v.vid, v.vs, v.ve,
        row_number() OVER (PARTITION BY e.l_orderkey, e.l_linenumber, e.l_partkey, e.l_suppkey
                           ORDER BY v.vs, v.ve, v.vid) AS rk
      FROM e JOIN v ON e.person_id = v.person_id
       AND date_trunc('millisecond', e.start_date) BETWEEN v.vs AND v.ve)
SELECT e.*, CAST(m.vid AS BIGINT) AS visit_occurrence_id, m.vs AS visit_start_datetime, m.ve AS visit_end_datetime
FROM e LEFT JOIN m ON e.l_orderkey = m.l_orderkey AND e.l_linenumber = m.l_linenumber
  AND e.l_partkey = m.l_partkey AND e.l_suppkey = m.l_suppkey AND m.rk = 1"""

ORACLE_SQL["shipment_visit_lookup"] = SHIPMENT_VISIT_LOOKUP


# -- operators that no table pipeline uses ---------------------------------------------

ORACLE_SQL.update({
    # lower() differs between engines only on letters with special casing, which the documents lack
    "normalize_text": "SELECT doc_id, translate(lower(text), 'áéíóúüñ', 'aeiouun') AS text_normalized FROM documents",
    "conform_schema": """SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS BIGINT) AS line,
        'LINES' AS vocabulary_id, CAST(l_quantity AS DOUBLE) AS quantity, CAST(0 AS DOUBLE) AS score,
        CAST(NULL AS VARCHAR) AS note FROM lineitem""",
    "transform_registry": f"""SELECT DISTINCT person_id, start_date, start_date AS end_date, type_concept
        FROM ({IV}) i WHERE start_date IS NOT NULL""",
    "gender": """SELECT c_custkey, CAST(CASE WHEN c_nationkey % 2 = 0 THEN 8507 ELSE 8532 END AS BIGINT) AS gender_concept_id,
        CAST(c_nationkey % 2 AS BIGINT) AS gender_source_concept_id,
        CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS gender_source_value FROM customer""",
    "provider_link": f"""WITH p AS ({PROVIDER}), l AS (SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber < 7 THEN CAST(l_suppkey AS VARCHAR) END AS sid FROM lineitem)
        SELECT l.*, p.provider_id FROM l LEFT JOIN p ON l.sid = p.provider_source_value""",
    "cohort_definition": f"""SELECT cohort_definition_id,
            CASE cohort_definition_id WHEN 1 THEN 'Building segment' ELSE 'Machinery segment' END AS cohort_definition_name,
            CAST(32882 AS BIGINT) AS definition_type_concept_id, CAST(1147314 AS BIGINT) AS subject_concept_id,
            COUNT(*) AS members FROM ({COHORT}) c GROUP BY cohort_definition_id""",
    "unmapped_conditions": f"""{_CONDITION_MAPPED}
        SELECT DISTINCT condition_source_value, condition_source_concept_id, condition_concept_id, vocabulary_id, type_concept
        FROM g WHERE condition_source_value IN
            (SELECT condition_source_value FROM g WHERE condition_concept_id IS NULL OR condition_concept_id = 0)""",
    "vocabulary_load": """SELECT CAST(p_partkey AS BIGINT) AS concept_id, '5" ' || p_name || ' "x' AS concept_name,
        p_brand AS vocabulary_id, 'C' || CAST(p_partkey AS VARCHAR) AS concept_code, DATE '1970-01-01' AS valid_start_date
        FROM part""",
    "vocabulary_last_wins": """SELECT 'C' || CAST(o_custkey AS VARCHAR) AS concept_code,
        CAST(coalesce(1000000000 + min(o_orderkey) FILTER (WHERE o_orderstatus = 'F'), max(o_orderkey)) AS BIGINT) AS concept_id
        FROM orders GROUP BY o_custkey""",
    "parquet_roundtrip": "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem",
    "coerced_dates": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 10 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS fec,
        CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS fin FROM orders""",
    "csv_ingest_hard": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, '"; ' || replace(text, '.', '."";') || '"' AS text
        FROM documents""",
})

ORACLE_SQL["csv_rejects"] = """
    WITH r AS (SELECT o_orderkey AS k, o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) ELSE ' ' END || '"so" ; text' AS t,
      CASE WHEN o_orderkey % 7 = 0 THEN '|EXTRA' ELSE '' END || CASE WHEN o_orderkey % 11 = 0 THEN '||X' ELSE '' END AS more FROM orders)
    SELECT CAST(k AS VARCHAR) AS o_orderkey, (2 + length(more) - length(replace(more, '|', ''))) || ' fields instead of 2' AS reason,
      k || '|' || t || more AS record FROM r WHERE more <> ''"""
