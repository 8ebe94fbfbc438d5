"""The same queries as plain SQL over the commerce tables.

Each relation is one SELECT that may name other relations; a query becomes a WITH
chain of the relations it needs. Everything is spelled out step by step, so that
the SQL shares no shortcut with the Spark code it is compared with.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}


def _relation(name: str, sql: str) -> None:
    RELATIONS[name] = sql.strip()


# --- clinical tables ---------------------------------------------------------

_relation("person", """
SELECT c_custkey AS person_id, c_mktsegment AS site,
       DATE '1970-01-01' + CAST((c_custkey * 37) % 9000 AS INTEGER) AS birth_date
FROM customer
""")
_relation("provider", """
SELECT s_suppkey AS provider_id, CAST(s_nationkey AS BIGINT) AS specialty_concept_id FROM supplier
""")
_relation("care_site", """
SELECT CAST(n_nationkey AS BIGINT) AS care_site_id,
       CAST(n_nationkey AS BIGINT) AS specialty_concept_id
FROM nation
""")
_relation("order_provider", """
SELECT l_orderkey, min(l_suppkey) AS provider_id FROM lineitem GROUP BY l_orderkey
""")
_relation("visit", """
SELECT o.o_orderkey AS visit_occurrence_id, o.o_custkey AS person_id, c.c_mktsegment AS site,
       CAST(o.o_orderdate AS DATE) AS visit_start_date,
       CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS visit_concept_id,
       o.o_orderpriority AS visit_concept_name,
       op.provider_id,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderkey % 25 END AS care_site_id
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN order_provider op ON op.l_orderkey = o.o_orderkey
""")
_relation("event", """
SELECT (l.l_orderkey * 8 + l.l_linenumber) * 1073741824 + l.l_partkey * 1024 + l.l_suppkey AS id,
       v.person_id, v.site, v.visit_occurrence_id,
       l.l_partkey AS concept_id, pt.p_name || ' ' || pt.p_type AS concept_name,
       CAST(l.l_linenumber AS BIGINT) AS type_concept_id,
       CAST(l.l_shipdate AS DATE) AS event_date,
       pt.p_brand || ' ' || pt.p_name AS source_value,
       l.l_partkey % 97 AS source_concept_id, pt.p_brand AS source_concept_name,
       CAST(floor(date_diff('day', p.birth_date, CAST(l.l_shipdate AS DATE)) / 30.4375) AS DOUBLE)
         AS age_in_months,
       l.l_returnflag AS kind
FROM lineitem l
JOIN visit v ON v.visit_occurrence_id = l.l_orderkey
JOIN person p ON p.person_id = v.person_id
JOIN part pt ON pt.p_partkey = l.l_partkey
""")
_relation("cond", """
SELECT id AS condition_occurrence_id, person_id, site, visit_occurrence_id,
       concept_id AS condition_concept_id, concept_name AS condition_concept_name,
       type_concept_id AS condition_type_concept_id, event_date AS condition_start_date,
       source_value AS condition_source_value, source_concept_id AS condition_source_concept_id,
       source_concept_name AS condition_source_concept_name,
       age_in_months AS condition_start_age_in_months
FROM event WHERE kind = 'R'
""")
_relation("proc", """
SELECT id AS procedure_occurrence_id, person_id, site, concept_id AS procedure_concept_id,
       concept_name AS procedure_concept_name, event_date AS procedure_date,
       source_value AS procedure_source_value, age_in_months AS procedure_age_in_months
FROM event WHERE kind = 'A'
""")
_relation("drug", "SELECT person_id, concept_id AS drug_concept_id FROM event WHERE kind = 'N'")

# --- code lists --------------------------------------------------------------

_relation("nephrology_list", """
SELECT CAST(n_nationkey AS BIGINT) AS concept_id FROM nation WHERE n_regionkey = 0
""")
_relation("rheum_nephr_list", """
SELECT CAST(n_nationkey AS BIGINT) AS concept_id FROM nation WHERE n_regionkey IN (0, 1)
""")
_relation("disease_list", """
SELECT p_partkey AS concept_id, p_name || ' ' || p_type AS concept_name,
       CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 100 AS VARCHAR) AS concept_code,
       p_brand AS vocabulary_id,
       CAST(CASE p_size % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS INTEGER)
         AS codeset_category_code,
       CASE p_size % 3 WHEN 1 THEN 'nephrotic' WHEN 0 THEN 'nephritic' ELSE 'broad' END
         AS codeset_category_name,
       CAST(CASE WHEN p_size BETWEEN 1 AND 5 THEN 1 ELSE 0 END AS INTEGER) AS other_code_req,
       CAST(CASE WHEN p_size IN (6, 12) THEN 1 ELSE 0 END AS INTEGER) AS neph_req
FROM part WHERE p_size <= 15
""")
for _name, _where in {
    "biopsy_list": "p_brand IN ('Brand#1', 'Brand#2')",
    "guidance_list": "p_brand IN ('Brand#3', 'Brand#4', 'Brand#5')",
    "transplant_proc_list": "p_brand = 'Brand#10'",
    "transplant_broad_list": "p_brand IN ('Brand#10', 'Brand#11')",
    "sle_incl_list": "p_type IN ('PROMO', 'LARGE')",
    "sle_excl_list": "p_brand = 'Brand#25' AND p_size >= 25",
    "sle_drug_list": "p_type = 'ECONOMY'",
    "sle_biopsy_list": "p_brand IN ('Brand#1', 'Brand#2')",
    "sle_guidance_list": "p_brand = 'Brand#3'",
}.items():
    _relation(_name, f"SELECT p_partkey AS concept_id FROM part WHERE {_where}")
_relation("pair_list", """
SELECT p_partkey AS concept_id,
       CAST(CASE WHEN p_size <= 15 THEN 1 ELSE 0 END AS INTEGER) AS kidney_related,
       CAST(CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 1 ELSE 0 END AS INTEGER) AS sle
FROM part WHERE p_size <= 15 OR p_type IN ('PROMO', 'LARGE')
""")

# --- specialty ---------------------------------------------------------------


def _specialty_events(name: str, visits: str, specialties: str) -> None:
    _relation(name, f"""
SELECT * FROM {visits} WHERE provider_id IN
  (SELECT provider_id FROM provider
   WHERE specialty_concept_id IN (SELECT concept_id FROM {specialties}))
UNION
SELECT * FROM {visits} WHERE care_site_id IN
  (SELECT care_site_id FROM care_site
   WHERE specialty_concept_id IN (SELECT concept_id FROM {specialties}))
""")


def _spaced_visits(name: str, events: str, types: str, min_visits: int, gap: int) -> None:
    _relation(f"{name}_in", f"""
SELECT * FROM {events}
WHERE visit_start_date >= DATE '1996-01-01' AND visit_start_date <= DATE '2000-12-31'
  AND visit_concept_id IN ({types})
""")
    _relation(f"{name}_summary", f"""
SELECT person_id, count(DISTINCT visit_start_date) AS distinct_dates,
       min(visit_start_date) AS first_date, max(visit_start_date) AS last_date
FROM {name}_in GROUP BY person_id HAVING count(DISTINCT visit_start_date) >= {min_visits}
""")
    _relation(f"{name}_persons", f"""
SELECT DISTINCT person_id, s.distinct_dates
FROM {name}_in v JOIN {name}_summary s USING (person_id)
WHERE v.visit_start_date <> s.first_date AND v.visit_start_date <> s.last_date
  AND date_diff('day', s.first_date, v.visit_start_date) >= {gap}
  AND date_diff('day', v.visit_start_date, s.last_date) >= {gap}
""")
    _relation(name, f"""
SELECT v.person_id, v.visit_occurrence_id, q.distinct_dates, v.site, v.visit_start_date,
       v.visit_concept_id, v.visit_concept_name, v.provider_id, v.care_site_id
FROM {name}_in i JOIN {name}_persons q ON q.person_id = i.person_id
JOIN visit v ON v.person_id = i.person_id AND v.visit_occurrence_id = i.visit_occurrence_id
""")


_specialty_events("specialty_events", "visit", "nephrology_list")
_specialty_events("rheum_nephr_events", "visit", "rheum_nephr_list")
_spaced_visits("nephrology_visits", "specialty_events", "1, 2, 3", 3, 7)
_spaced_visits("nephrology_visits_exp", "specialty_events", "1, 2, 3, 4", 3, 7)
_spaced_visits("spaced_specialty_visits", "rheum_nephr_events", "1, 2, 3, 4", 4, 30)


def _visit_specialties(name: str, cohort: str, extra: str = "") -> None:
    arms = [
        f"""
SELECT DISTINCT v.person_id, v.site, v.visit_occurrence_id, v.visit_start_date,
       t.specialty_concept_id, '{table}' AS spec_flag, v.visit_concept_id{extra}
FROM visit v JOIN {table} t ON t.{table}_id = v.{table}_id
WHERE v.person_id IN (SELECT person_id FROM {cohort})"""
        for table in ("provider", "care_site")
    ]
    _relation(name, " UNION ".join(arms))


_visit_specialties("visits_with_specialty", "incl_excl_conditions")
_visit_specialties("visit_table_specialty", "biopsied", ", v.visit_concept_name")

_relation("eligible_visits_in", """
SELECT DISTINCT person_id, site, visit_occurrence_id, specialty_concept_id, spec_flag,
       visit_concept_id
FROM visits_with_specialty
WHERE specialty_concept_id IN (SELECT concept_id FROM rheum_nephr_list)
  AND visit_concept_id IN (1, 2, 3)
""")
_relation("eligible_visit_counts", """
SELECT person_id, count(DISTINCT visit_occurrence_id) AS n_visits
FROM eligible_visits_in GROUP BY person_id HAVING count(DISTINCT visit_occurrence_id) >= 2
""")
_relation("eligible_visits", """
SELECT i.*, c.n_visits FROM eligible_visits_in i
JOIN eligible_visit_counts c ON c.person_id = i.person_id
""")
_relation("population_visits", """
SELECT v.person_id, v.visit_start_date, v.visit_occurrence_id, v.visit_concept_id, v.provider_id,
       v.care_site_id, 'provider' AS spec_flag, t.specialty_concept_id
FROM visit v JOIN provider t ON t.provider_id = v.provider_id
WHERE t.specialty_concept_id IN (SELECT concept_id FROM rheum_nephr_list)
  AND v.visit_concept_id IN (1, 2, 3)
UNION
SELECT v.person_id, v.visit_start_date, v.visit_occurrence_id, v.visit_concept_id, v.provider_id,
       v.care_site_id, 'care_site', t.specialty_concept_id
FROM visit v JOIN care_site t ON t.care_site_id = v.care_site_id
WHERE t.specialty_concept_id IN (SELECT concept_id FROM rheum_nephr_list)
  AND v.visit_concept_id IN (1, 2, 3)
""")
_relation("population_eligible_visits", """
SELECT p.person_id, p.visit_start_date, p.visit_occurrence_id, p.visit_concept_id, p.provider_id,
       p.care_site_id, p.spec_flag, c.n_visits
FROM population_visits p
JOIN (SELECT person_id, count(DISTINCT visit_occurrence_id) AS n_visits
      FROM population_visits GROUP BY person_id) c ON c.person_id = p.person_id
WHERE c.n_visits >= 2
""")

# --- procedures and conditions of a list -------------------------------------

_relation("biopsied", """
SELECT DISTINCT person_id FROM proc
WHERE procedure_concept_id IN (SELECT concept_id FROM biopsy_list)
""")
_relation("add_site", """
SELECT b.person_id, p.site FROM biopsied b JOIN person p ON p.person_id = b.person_id
""")
_relation("procedures_in_codeset", """
SELECT pr.*, p.birth_date,
       CAST(date_diff('day', p.birth_date, pr.procedure_date) AS INTEGER) AS procedure_age_days
FROM proc pr JOIN person p ON p.person_id = pr.person_id
JOIN biopsied b ON b.person_id = pr.person_id
WHERE pr.procedure_concept_id IN (SELECT concept_id FROM transplant_proc_list)
""")
_relation("conditions_in_codeset", """
SELECT c.*, p.birth_date,
       CAST(date_diff('day', p.birth_date, c.condition_start_date) AS INTEGER)
         AS condition_age_days
FROM cond c JOIN person p ON p.person_id = c.person_id
WHERE c.condition_concept_id IN (SELECT concept_id FROM transplant_broad_list)
""")


def _transplant_events(name: str, cohort: str) -> None:
    _relation(name, f"""
SELECT * FROM (
  SELECT c.person_id, c.site, c.condition_occurrence_id AS occurrence_id,
         c.condition_concept_id AS concept_id, c.condition_source_value AS source_value,
         c.condition_concept_name AS concept_name, 'condition' AS table_name, 'cond' AS approach,
         c.condition_start_date AS transplant_date,
         CAST(date_diff('day', p.birth_date, c.condition_start_date) AS INTEGER) AS age_in_days
  FROM cond c JOIN person p ON p.person_id = c.person_id
  WHERE c.condition_concept_id IN (SELECT concept_id FROM transplant_broad_list)
    AND c.person_id IN (SELECT person_id FROM {cohort})
  UNION
  SELECT r.person_id, r.site, r.procedure_occurrence_id, r.procedure_concept_id,
         r.procedure_source_value, r.procedure_concept_name, 'procedure', 'proc',
         r.procedure_date,
         CAST(date_diff('day', p.birth_date, r.procedure_date) AS INTEGER)
  FROM proc r JOIN person p ON p.person_id = r.person_id
  WHERE r.procedure_concept_id IN (SELECT concept_id FROM transplant_broad_list)
    AND r.person_id IN (SELECT person_id FROM {cohort})
)
WHERE age_in_days < 365.25 * 30
  AND transplant_date >= DATE '1996-01-01' AND transplant_date <= DATE '2000-12-31'
""")


_transplant_events("transplant_events", "biopsied")
_transplant_events("nephrotic_kt", "nephrotic_subcohort")


def _biopsy_procedures(name: str, procedures: str, cohort: str) -> None:
    columns = """r.person_id, r.procedure_occurrence_id AS occurrence_id,
       r.procedure_concept_id AS concept_id, r.procedure_concept_name AS concept_name,
       r.procedure_date AS biopsy_date, r.procedure_source_value AS source_value,
       'procedure' AS table_name, 'procedure' AS approach"""
    _relation(name, f"""
SELECT {columns}
FROM {procedures} r WHERE r.person_id IN (SELECT person_id FROM {cohort})
  AND r.procedure_concept_id IN (SELECT concept_id FROM biopsy_list)
UNION
SELECT {columns}
FROM {procedures} r WHERE r.person_id IN (SELECT person_id FROM {cohort})
  AND r.procedure_concept_id IN (SELECT concept_id FROM guidance_list)
  AND NOT regexp_matches(lower(r.procedure_source_value), 'red')
  AND (regexp_matches(lower(r.procedure_source_value), 'ring')
       OR regexp_matches(lower(r.procedure_source_value), 'widget'))
""")


_biopsy_procedures("biopsy_procedures", "proc", "incl_excl_conditions")


def _biopsy_before_transplant(name: str, cohort: str, age: int) -> None:
    _relation(
        f"{name}_young", f"SELECT * FROM proc WHERE procedure_age_in_months < 12 * {age}"
    )
    _biopsy_procedures(f"{name}_biopsies", f"{name}_young", cohort)
    _relation(name, f"""
SELECT c.*, b.min_biopsy_date, t.min_transplant_date
FROM {cohort} c
JOIN (SELECT person_id, min(biopsy_date) AS min_biopsy_date
      FROM {name}_biopsies GROUP BY person_id) b ON b.person_id = c.person_id
LEFT JOIN (SELECT person_id, min(procedure_date) AS min_transplant_date FROM {name}_young
           WHERE procedure_concept_id IN (SELECT concept_id FROM transplant_proc_list)
           GROUP BY person_id) t ON t.person_id = c.person_id
WHERE t.min_transplant_date IS NULL OR b.min_biopsy_date < t.min_transplant_date
""")


_relation("person_site", "SELECT person_id, site FROM person")
_biopsy_before_transplant("biopsy_before_transplant", "person_site", 30)

# --- disease cohort ----------------------------------------------------------


def _disease_cohort(name: str, specialties: str, age: int) -> None:
    _relation(f"{name}_raw", f"""
SELECT * FROM cond WHERE condition_concept_id IN (SELECT concept_id FROM disease_list)
  AND condition_start_age_in_months < 12 * {age}
  AND condition_start_date >= DATE '1996-01-01' AND condition_start_date <= DATE '2000-12-31'
""")
    _relation(f"{name}_linked_visits", f"""
SELECT * FROM visit
WHERE visit_occurrence_id IN (SELECT visit_occurrence_id FROM {name}_raw)
""")
    _specialty_events(f"{name}_specialty_visits", f"{name}_linked_visits", specialties)
    _relation(f"{name}_conds", f"""
SELECT * FROM {name}_raw WHERE condition_concept_id NOT IN
  (SELECT concept_id FROM disease_list WHERE neph_req = 1)
UNION
SELECT * FROM {name}_raw
WHERE condition_concept_id IN (SELECT concept_id FROM disease_list WHERE neph_req = 1)
  AND visit_occurrence_id IN (SELECT visit_occurrence_id FROM {name}_specialty_visits)
""")
    _relation(f"{name}_one", f"""
SELECT person_id, site, count(DISTINCT condition_start_date) AS n_glomerular_dx_dates,
       count(DISTINCT condition_occurrence_id) AS n_glomerular_dx,
       count(DISTINCT condition_concept_id) AS n_distinct_glomerular_dx
FROM {name}_conds GROUP BY person_id, site
""")
    _relation(f"{name}_two", f"SELECT * FROM {name}_one WHERE n_glomerular_dx_dates >= 2")
    _biopsy_before_transplant(f"{name}_biopsied", f"{name}_one", age)
    _relation(f"{name}_weak", f"""
SELECT w.person_id
FROM (SELECT person_id, site, count(DISTINCT condition_concept_id) AS n_weak FROM {name}_conds
      WHERE condition_concept_id IN (SELECT concept_id FROM disease_list WHERE other_code_req = 1)
      GROUP BY person_id, site) w
JOIN {name}_two t ON t.person_id = w.person_id
WHERE w.n_weak = t.n_distinct_glomerular_dx
""")
    _relation(f"{name}_two_ok", f"""
SELECT person_id, site, 'two_codes' AS entry, n_glomerular_dx, n_distinct_glomerular_dx,
       n_glomerular_dx_dates
FROM {name}_two t
WHERE NOT EXISTS (SELECT 1 FROM {name}_weak w WHERE w.person_id = t.person_id)
""")
    _relation(name, f"""
SELECT * FROM {name}_two_ok
UNION
SELECT person_id, site, 'one_code_w_biopsy', NULL, NULL, n_glomerular_dx_dates
FROM {name}_biopsied b
WHERE min_biopsy_date >= DATE '1996-01-01' AND min_biopsy_date <= DATE '2000-12-31'
  AND NOT EXISTS (SELECT 1 FROM {name}_two_ok t WHERE t.person_id = b.person_id)
""")


_disease_cohort("disease_cohort", "rheum_nephr_list", 25)
_disease_cohort("glomerular_disease_cohort", "nephrology_list", 30)


def _dominant_category(name: str, cohort: str) -> None:
    for column, category in (("n_nephrotic_dx", 1), ("n_nephritic_dx", 2)):
        _relation(f"{name}_{column}", f"""
SELECT person_id, count(DISTINCT condition_start_date) AS {column} FROM cond
WHERE condition_concept_id IN
  (SELECT concept_id FROM disease_list WHERE codeset_category_code = {category})
GROUP BY person_id
""")
    _relation(name, f"""
SELECT * FROM (
  SELECT c.person_id, coalesce(a.n_nephrotic_dx, 0) AS n_nephrotic_dx,
         coalesce(b.n_nephritic_dx, 0) AS n_nephritic_dx
  FROM (SELECT DISTINCT person_id FROM {cohort}) c
  LEFT JOIN {name}_n_nephrotic_dx a ON a.person_id = c.person_id
  LEFT JOIN {name}_n_nephritic_dx b ON b.person_id = c.person_id
) WHERE n_nephrotic_dx > n_nephritic_dx
""")


_dominant_category("dominant_category_subcohort", "biopsied")
_dominant_category("nephrotic_subcohort", "glomerular_disease_cohort")

# --- lupus -------------------------------------------------------------------

_CONDITION_ROW = """condition_occurrence_id, person_id, site, visit_occurrence_id,
       condition_concept_id, condition_concept_name, condition_type_concept_id,
       condition_start_date, condition_source_value"""

_relation("incl_excl_conditions", f"""
SELECT DISTINCT {_CONDITION_ROW}
FROM cond WHERE condition_concept_id IN (SELECT concept_id FROM sle_incl_list)
  AND person_id NOT IN
    (SELECT person_id FROM cond
     WHERE condition_concept_id IN (SELECT concept_id FROM sle_excl_list))
""")
_relation("conditions_with_eligible_visits", f"""
SELECT DISTINCT {_CONDITION_ROW}
FROM incl_excl_conditions WHERE person_id IN (SELECT person_id FROM eligible_visits)
""")


def _dated(name: str, rows: str, where: str) -> None:
    _relation(name, f"""
SELECT person_id, site, condition_start_date FROM (
  SELECT person_id, site, condition_start_date,
         min(condition_start_date) OVER (PARTITION BY person_id, site) AS first_date,
         max(condition_start_date) OVER (PARTITION BY person_id, site) AS last_date
  FROM (SELECT DISTINCT person_id, site, condition_start_date FROM {rows})
) WHERE {where}
""")


_SPREAD = "date_diff('day', first_date, last_date) >= 60"
_SPACED = """condition_start_date <> first_date AND condition_start_date <> last_date
  AND date_diff('day', first_date, condition_start_date) >= 30
  AND date_diff('day', condition_start_date, last_date) >= 30"""
_dated("two_codes_spread", "conditions_with_eligible_visits", _SPREAD)
_dated("three_codes_spaced", "conditions_with_eligible_visits", _SPACED)
_dated("nephritis_spaced", "same_date_pair_for_cohort", _SPACED)


def _literal_biopsies(name: str, cohort: str) -> None:
    _relation(name, f"""
SELECT procedure_occurrence_id, person_id, site, procedure_date, procedure_concept_id,
       procedure_concept_name, procedure_source_value
FROM proc
WHERE person_id IN (SELECT person_id FROM {cohort})
  AND (procedure_concept_id IN (SELECT concept_id FROM sle_biopsy_list)
       OR (procedure_concept_id IN (SELECT concept_id FROM sle_guidance_list)
           AND (regexp_matches(lower(procedure_source_value), 'ring')
                OR regexp_matches(lower(procedure_source_value), 'widget'))))
""")


def _followup(name: str, cohort: str) -> None:
    _relation(name, f"""
SELECT * FROM (
  SELECT person_id, max(visit_start_date) AS max_date, min(visit_start_date) AS min_date,
         CAST(date_diff('day', min(visit_start_date), max(visit_start_date)) AS INTEGER)
           AS days_sep
  FROM visit WHERE person_id IN (SELECT person_id FROM {cohort}) GROUP BY person_id
) WHERE days_sep >= 60
""")


def _exposed_with_site(name: str, persons: str) -> None:
    _relation(name, f"""
SELECT p.person_id, p.site FROM person p
WHERE p.person_id IN ({persons})
  AND p.person_id IN
    (SELECT person_id FROM drug WHERE drug_concept_id IN (SELECT concept_id FROM sle_drug_list))
""")


_literal_biopsies("biopsy_by_literal_codes", "conditions_with_eligible_visits")
_literal_biopsies("ln_biopsies", "sle_persons")
_followup("followup_at_least", "biopsied")
_followup("sle_followed", "biopsy_by_literal_codes")
_followup("ln_followed", "ln_biopsies")
_relation("persons_exposed_to_drug", """
SELECT DISTINCT person_id FROM drug
WHERE drug_concept_id IN (SELECT concept_id FROM sle_drug_list)
  AND person_id IN (SELECT person_id FROM incl_excl_conditions)
""")
_exposed_with_site(
    "sle_cohort",
    "SELECT person_id FROM three_codes_spaced UNION SELECT person_id FROM sle_followed",
)
_exposed_with_site("sle_cohort_no_biopsy", "SELECT person_id FROM three_codes_spaced")
_exposed_with_site(
    "ln_cohort",
    "SELECT person_id FROM nephritis_spaced UNION SELECT person_id FROM ln_followed",
)
_exposed_with_site("ln_cohort_no_biopsy", "SELECT person_id FROM nephritis_spaced")
_relation("persons_with_any_code", """
SELECT DISTINCT p.person_id, p.site
FROM cond c JOIN person p ON p.person_id = c.person_id
WHERE c.condition_concept_id IN (SELECT concept_id FROM disease_list)
  AND c.person_id IN (SELECT person_id FROM biopsied)
""")
_relation("sle_persons", """
SELECT DISTINCT person_id FROM cond
WHERE condition_concept_id IN (SELECT concept_id FROM sle_incl_list)
  AND person_id IN (SELECT person_id FROM conditions_with_eligible_visits)
""")


def _same_date_pair(name: str, conditions: str) -> None:
    _relation(name, f"""
SELECT * FROM (
  SELECT d.*,
         max(CASE WHEN kidney_related = 1 THEN 1 ELSE 0 END)
           OVER (PARTITION BY person_id, condition_start_date) AS any_kidney_related,
         max(CASE WHEN sle = 1 THEN 1 ELSE 0 END)
           OVER (PARTITION BY person_id, condition_start_date) AS any_sle,
         1 AS kidney_related_and_sle
  FROM (SELECT DISTINCT c.condition_occurrence_id, c.person_id, c.site, c.condition_start_date,
               c.condition_concept_id, c.condition_concept_name, c.condition_source_concept_id,
               c.condition_source_concept_name, c.condition_source_value, c.visit_occurrence_id,
               l.kidney_related, l.sle
        FROM {conditions} c JOIN pair_list l ON l.concept_id = c.condition_concept_id) d
) WHERE any_kidney_related = 1 AND any_sle = 1
""")


_same_date_pair("same_date_pair", "cond")
_relation("seen_sle_conditions", """
SELECT * FROM cond WHERE person_id IN (SELECT person_id FROM conditions_with_eligible_visits)
""")
_same_date_pair("same_date_pair_for_cohort", "seen_sle_conditions")

# --- study steps -------------------------------------------------------------

_relation("nephrotic_kt_src", """
SELECT * FROM cond WHERE condition_source_concept_id IN (11, 22, 33)
  AND person_id IN (SELECT person_id FROM nephrotic_subcohort)
""")
for _name, _rows in {
    "nephrology_visit_cohort": "nephrology_visits",
    "nephrology_visit_cohort_exp": "nephrology_visits_exp",
    "nephrotic_kt_cohort": "nephrotic_kt",
    "nephrotic_kt_src_cohort": "nephrotic_kt_src",
    "sle_i_e_pats": "incl_excl_conditions",
    "sle_i_e_pats_w_elig_visits": "conditions_with_eligible_visits",
}.items():
    _relation(_name, f"SELECT DISTINCT person_id, site FROM {_rows}")
for _name in (
    "glomerular_disease_cohort",
    "nephrotic_subcohort",
    "nephrotic_kt_cohort",
    "nephrotic_kt_src_cohort",
):
    _relation(f"{_name}_w_neph", f"""
SELECT * FROM {_name} WHERE person_id IN (SELECT person_id FROM nephrology_visit_cohort)
""")
for _name, _rows in {
    "nephrotic_kt_no_sle": "nephrotic_kt_cohort",
    "nephrotic_kt_src_no_sle": "nephrotic_kt_src_cohort",
}.items():
    _relation(_name, f"""
SELECT r.* FROM {_rows} r
WHERE NOT EXISTS (SELECT 1 FROM sle_cohort s WHERE s.person_id = r.person_id)
""")
_relation("final_cohort", """
SELECT person_id, site FROM (
  SELECT person_id, site FROM nephrotic_kt_no_sle
  UNION SELECT person_id, site FROM nephrotic_kt_src_no_sle
) WHERE person_id IN (SELECT person_id FROM nephrology_visit_cohort_exp)
""")

_COUNTED = (
    "nephrology_visit_cohort",
    "nephrology_visit_cohort_exp",
    "glomerular_disease_cohort",
    "glomerular_disease_cohort_w_neph",
    "nephrotic_subcohort",
    "nephrotic_subcohort_w_neph",
    "nephrotic_kt",
    "nephrotic_kt_cohort_w_neph",
    "nephrotic_kt_src_cohort",
    "nephrotic_kt_src_cohort_w_neph",
    "sle_i_e_pats",
    "sle_i_e_pats_w_elig_visits",
    "sle_cohort",
    "nephrotic_kt_no_sle",
    "nephrotic_kt_src_no_sle",
)
_relation("attrition", " UNION ALL ".join(
    [
        "SELECT CAST(0 AS INTEGER) AS step_no, 'start' AS cohort, CAST(0 AS BIGINT) AS persons",
        *(
            f"SELECT {no}, '{name}', (SELECT count(DISTINCT person_id) FROM {name})"
            for no, name in enumerate(_COUNTED, start=1)
        ),
    ]
))

# --- sources -----------------------------------------------------------------

for _name, _table in {
    "cdm_person": "person",
    "cdm_visit_occurrence": "visit",
    "cdm_condition_occurrence": "cond",
    "cdm_procedure_occurrence": "proc",
    "cdm_drug_exposure": "drug",
    "cdm_provider": "provider",
    "cdm_care_site": "care_site",
    "codeset_load": "disease_list",
    "result_round_trip": "visit",
}.items():
    _relation(_name, f"SELECT * FROM {_table}")
_relation("disease_code_flags", """
SELECT 'other_code_req' AS flag, concept_id FROM disease_list WHERE other_code_req = 1
UNION ALL SELECT 'neph_req', concept_id FROM disease_list WHERE neph_req = 1
UNION ALL SELECT 'nephrotic', concept_id FROM disease_list WHERE codeset_category_code = 1
UNION ALL SELECT 'nephritic', concept_id FROM disease_list WHERE codeset_category_code = 2
""")


def query_sql(name: str) -> str:
    """The relation as one statement over the registered tables."""
    needed: list[str] = []

    def visit(relation: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", RELATIONS[relation])):
            if word in RELATIONS and word not in needed and word != relation:
                visit(word)
                needed.append(word)

    visit(name)
    # Materialized, so that a relation that many others name is worked out once.
    chain = ",\n".join(f"{r} AS MATERIALIZED (\n{RELATIONS[r]}\n)" for r in needed)
    return f"WITH {chain}\n{RELATIONS[name]}" if needed else RELATIONS[name]
