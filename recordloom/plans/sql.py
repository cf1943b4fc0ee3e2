"""The same queries as SQL for DuckDB: written on their own, not made from the DataFrame plans."""

from __future__ import annotations

from recordloom.functions.text import ADDR_MAP, LEGAL_TOKENS, NAME_MAP
from recordloom.operators.evaluate import GRID


def _list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _clean(x: str) -> str:
    out = f"replace(lower(strip_accents(coalesce({x}, ''))), '&', ' and ')"
    for _ in range(2):
        out = f"regexp_replace({out}, '([a-z])\\.([a-z])', '\\1\\2', 'g')"
    return f"trim(regexp_replace(regexp_replace({out}, '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def _ratio(num: str, den: str) -> str:
    """num / den of whole numbers, half up at six digits."""
    return f"CAST((2000000 * CAST({num} AS BIGINT) + ({den})) // (2 * ({den})) AS DOUBLE) / 1e6::DOUBLE"


def _rewrite(x: str, m: dict[str, str]) -> str:
    pairs = f"map({_list(m)}, {_list(m.values())})"
    return f"array_to_string(list_transform(list_filter(string_split({x}, ' '), lambda t: t <> ''), lambda t: coalesce({pairs}[t], t)), ' ')"


CTES = {
    "rec": """SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, 'S' || (doc_id % 3 + 1) AS src, lang AS country,
  array_to_string(w[1:6], ' ') AS name, array_to_string(w[7:], ' ') AS addr
  FROM (SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM documents)""",
    "n0": f"""SELECT *, {_rewrite(_clean('name'), NAME_MAP)} AS name_n, {_rewrite(_clean('addr'), ADDR_MAP)} AS addr_n, {_clean('country')} AS country_c FROM rec""",
    "n1": f"""SELECT *, array_to_string(list_filter(string_split(name_n, ' '), lambda t: t <> '' AND NOT list_contains({_list(LEGAL_TOKENS)}, t)), ' ') AS c0 FROM n0""",
    "norm": """SELECT entity_id, src, country_c AS country_n, name_n, CASE WHEN c0 = '' THEN name_n ELSE c0 END AS name_core, addr_n,
  (CASE WHEN c0 = '' THEN name_n ELSE c0 END) || ' | ' || addr_n AS full_n,
  list_distinct(regexp_extract_all(addr, '\\b([0-9]{5,6})\\b', 1)) AS postal, list_distinct(regexp_extract_all(addr, '([0-9]+)', 1)) AS nums,
  coalesce(list_min(list_transform(regexp_extract_all(addr, '\\b([0-9]{5,6})\\b', 1), lambda x: CAST(x AS INTEGER))), 0) AS postal1 FROM n1""",
    "s1": "SELECT entity_id AS s1_id, country_n FROM norm WHERE src = 'S1'",
    "ntok": "SELECT DISTINCT entity_id, country_n, unnest(string_split(name_core, ' ')) AS tok FROM norm WHERE name_core <> ''",
    "atok": "SELECT DISTINCT entity_id, country_n, unnest(string_split(addr_n, ' ')) AS tok FROM norm WHERE addr_n <> ''",
    "ndf": "SELECT country_n, tok, count(*) AS df FROM ntok GROUP BY ALL",
    "adf": "SELECT country_n, tok, count(*) AS df FROM atok GROUP BY ALL",
    "nrare": "SELECT entity_id, country_n, tok, df, row_number() OVER (PARTITION BY entity_id ORDER BY df, tok) AS rank FROM ntok JOIN ndf USING (country_n, tok) QUALIFY rank <= 3",
    "arare": "SELECT entity_id, country_n, tok, df, row_number() OVER (PARTITION BY entity_id ORDER BY df, tok) AS rank FROM atok JOIN adf USING (country_n, tok) QUALIFY rank <= 2",
    "keys": """SELECT * FROM (
  SELECT entity_id, country_n, 'pfx5' AS scheme, left(replace(name_core, ' ', ''), 5) AS key FROM norm
  UNION ALL SELECT entity_id, country_n, 'postal', postal1 || '|' || left(replace(name_core, ' ', ''), 1) FROM norm WHERE postal1 > 0
  UNION ALL SELECT entity_id, country_n, 'nametok', 'n:' || tok FROM nrare
  UNION ALL SELECT entity_id, country_n, 'addrtok', 'a:' || tok FROM arare) WHERE key <> ''""",
    "blk": "SELECT country_n, scheme, key, count(*) AS n FROM keys WHERE entity_id NOT LIKE 'S1%' GROUP BY ALL",
    "kp": """SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, country_n, scheme, key FROM keys a JOIN blk USING (country_n, scheme, key)
  JOIN keys b USING (country_n, scheme, key) WHERE n <= 20000 AND a.entity_id LIKE 'S1%' AND b.entity_id NOT LIKE 'S1%'""",
    "cand": "SELECT DISTINCT s1_id, cand_id FROM kp",
    "toks": "SELECT entity_id, list_distinct(list_filter(string_split(name_core, ' '), lambda t: t <> '')) AS nt, list_distinct(list_filter(string_split(addr_n, ' '), lambda t: t <> '')) AS adt FROM norm",
    "cnt": """SELECT s1_id, cand_id, len(list_intersect(a.nt, b.nt)) AS ni, len(a.nt) AS na, len(b.nt) AS nb, len(list_intersect(a.adt, b.adt)) AS ai, len(a.adt) AS aa, len(b.adt) AS ab
  FROM cand JOIN toks a ON a.entity_id = s1_id JOIN toks b ON b.entity_id = cand_id""",
    "scored": f"""SELECT s1_id, cand_id, {_ratio("ni * av + ai * nu", "2 * nu * av")} AS p FROM (SELECT *, greatest(na + nb - ni, 1) AS nu, greatest(aa + ab - ai, 1) AS av FROM cnt)""",
    "sets": "SELECT entity_id, src, country_n, list_distinct(list_filter(string_split(name_n || ' ' || addr_n, ' '), lambda t: t <> '')) AS t FROM norm",
    "truth": """SELECT s1_id, cand_id FROM (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, len(list_intersect(a.t, b.t)) AS i, len(a.t) AS x, len(b.t) AS y
  FROM sets a JOIN sets b ON a.country_n = b.country_n AND a.src = 'S1' AND b.src <> 'S1' AND len(a.t) >= 0.7 * len(b.t) AND len(b.t) >= 0.7 * len(a.t) AND len(a.t) > 0)
  WHERE i >= CAST(0.7 AS DOUBLE) * (x + y - i)""",
    "exk": """SELECT entity_id, 'p|' || name_core || '|' || list_min(postal) AS key FROM norm WHERE name_core <> '' AND len(postal) > 0
  UNION ALL SELECT entity_id, 'a|' || name_core || '|' || addr_n FROM norm WHERE name_core <> '' AND addr_n <> ''""",
    "exn": "SELECT key FROM exk GROUP BY key HAVING count(*) FILTER (entity_id LIKE 'S1%') BETWEEN 1 AND 50 AND count(*) FILTER (entity_id NOT LIKE 'S1%') BETWEEN 1 AND 50",
    "exact": "SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cand_id FROM exk a JOIN exn USING (key) JOIN exk b USING (key) WHERE a.entity_id LIKE 'S1%' AND b.entity_id NOT LIKE 'S1%'",
}


def _view(name: str, words: str, grams: str) -> dict[str, str]:
    """CTEs of a TF-IDF view: tf_, df_, raw_, post_."""
    return {
        f"g_{name}": f"SELECT entity_id, country_n, term, count(*) AS tf FROM ({grams.format(words=words)}) GROUP BY ALL",
        f"tot_{name}": "SELECT country_n, CAST(count(*) AS DOUBLE) AS total FROM norm GROUP BY ALL",
        f"df_{name}": f"SELECT country_n, term, count(*) AS df, any_value(total) AS total FROM g_{name} JOIN tot_{name} USING (country_n) GROUP BY ALL",
        f"fit_{name}": f"SELECT country_n, count(*) FILTER (df >= 2 AND df <= 0.01::DOUBLE * total) AS n FROM df_{name} GROUP BY ALL",
        f"raw_{name}": f"SELECT entity_id, country_n, term, (1 + ln(tf)) * (ln((1 + total) / (1 + df)) + 1) AS x FROM g_{name} JOIN df_{name} USING (country_n, term) JOIN fit_{name} USING (country_n) WHERE (df >= 2 AND df <= 0.01::DOUBLE * total) OR n = 0 OR 0.01::DOUBLE * total < 2",
        f"post_{name}": f"SELECT entity_id, country_n, term, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS w FROM raw_{name}",
    }


def _chars(lo: int, hi: int) -> str:
    parts = [f"SELECT entity_id, country_n, unnest(list_transform(range(1, len(pw) - {n} + 2), lambda i: substring(pw, i, {n}))) AS term FROM pw WHERE len(pw) >= {n}" for n in range(lo, hi + 1)]
    parts.append(f"SELECT entity_id, country_n, pw FROM pw WHERE len(pw) < {lo}")
    return "WITH pw AS ({words}) " + " UNION ALL ".join(parts)


CTES |= _view("name", "SELECT entity_id, country_n, ' ' || unnest(string_split(name_core, ' ')) || ' ' AS pw FROM norm WHERE name_core <> ''", _chars(2, 4))
CTES |= _view("full", "SELECT entity_id, country_n, ' ' || w || ' ' AS pw FROM (SELECT entity_id, country_n, unnest(string_split(full_n, ' ')) AS w FROM norm) WHERE w <> ''", _chars(3, 4))
CTES |= _view(
    "addr",
    "SELECT entity_id, country_n, list_filter(string_split(addr_n, ' '), lambda t: len(t) >= 2) AS t FROM norm",
    "WITH b AS ({words}) SELECT entity_id, country_n, unnest(t) AS term FROM b UNION ALL SELECT entity_id, country_n, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM b",
)
for _v in ("name", "full", "addr"):
    CTES[f"dot_{_v}"] = f"SELECT s1_id, cand_id, sum(a.w * b.w) AS c FROM cand JOIN post_{_v} a ON a.entity_id = s1_id JOIN post_{_v} b ON b.entity_id = cand_id AND b.term = a.term GROUP BY ALL"
CTES["cos"] = """SELECT cand.s1_id, cand.cand_id, country_n, round(coalesce(n.c, 0.0), 6) AS cos_name, round(coalesce(f.c, 0.0), 6) AS cos_full, round(coalesce(d.c, 0.0), 6) AS cos_addr
  FROM cand JOIN s1 USING (s1_id) LEFT JOIN dot_name n ON n.s1_id = cand.s1_id AND n.cand_id = cand.cand_id LEFT JOIN dot_full f ON f.s1_id = cand.s1_id AND f.cand_id = cand.cand_id LEFT JOIN dot_addr d ON d.s1_id = cand.s1_id AND d.cand_id = cand.cand_id"""
CTES["fold"] = "SELECT s1_id, CAST((row_number() OVER (ORDER BY md5(s1_id), s1_id) - 1) % 5 AS INTEGER) AS fold FROM s1"


def _award(source: str) -> str:
    return f"SELECT s1_id, cand_id, p FROM {source} QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, s1_id) = 1"


CTES["rule50"] = "SELECT * FROM scored WHERE p >= 0.5"
CTES["rule50o"] = _award("rule50")
CTES["rule30"] = "SELECT * FROM scored WHERE p >= 0.3"
CTES["rule30o"] = _award("rule30")
CTES["rule10"] = "SELECT * FROM scored WHERE p >= 0.1"
CTES["rule10o"] = _award("rule10")
CTES["ef"] = """SELECT *, row_number() OVER o AS k, sum(p) OVER (PARTITION BY s1_id ORDER BY p DESC, cand_id ROWS UNBOUNDED PRECEDING) AS top, sum(p) OVER (PARTITION BY s1_id) AS total,
  exp(sum(ln(1 - least(p, 1 - 1e-12))) OVER (PARTITION BY s1_id)) AS nothing FROM rule10o WINDOW o AS (PARTITION BY s1_id ORDER BY p DESC, cand_id)"""
CTES["ef2"] = "SELECT *, 1.25::DOUBLE * top / (0.25::DOUBLE * total + k) AS f, max(1.25::DOUBLE * top / (0.25::DOUBLE * total + k)) OVER (PARTITION BY s1_id) AS best FROM ef"
CTES["ef3"] = "SELECT *, min(CASE WHEN f >= best - 1e-12 THEN k END) OVER (PARTITION BY s1_id) AS stop FROM ef2"
CTES["expected"] = "SELECT s1_id, cand_id, p FROM ef3 WHERE best > nothing AND k <= stop"
CTES["nt"] = "SELECT s1_id, count(*) AS n_true FROM truth GROUP BY ALL"

F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN n_pred = 0 OR tp = 0 THEN 0.0 ELSE 1.25::DOUBLE * tp / (0.25::DOUBLE * n_true + n_pred) END"


def _counts(pred: str) -> str:
    return f"""SELECT s1.s1_id, s1.country_n, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true FROM s1
  LEFT JOIN (SELECT s1_id, count(*) AS n_pred, count(t.cand_id) AS tp FROM {pred} x LEFT JOIN truth t USING (s1_id, cand_id) GROUP BY ALL) USING (s1_id) LEFT JOIN nt USING (s1_id)"""


CTES["c50"] = _counts("rule50")
CTES["c50o"] = _counts("rule50o")
CTES["ccand"] = _counts("cand")
CTES["cexact"] = _counts("exact")
CTES["grid"] = "SELECT unnest([" + ", ".join(f"{t}::DOUBLE" for t in GRID) + "]) AS t"


def _curve(ids: str, pairs: str) -> str:
    return f"""SELECT frame, t, round(avg({F05}), 6) AS macro_f05 FROM (SELECT i.frame, i.s1_id, t, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS n_true
  FROM {ids} i CROSS JOIN grid LEFT JOIN (SELECT x.frame, x.s1_id, g.t, count(*) AS n_pred, count(tr.cand_id) AS tp FROM {pairs} x JOIN grid g ON g.t <= x.p LEFT JOIN truth tr USING (s1_id, cand_id) GROUP BY ALL) y
  USING (frame, s1_id, t) LEFT JOIN nt USING (s1_id)) GROUP BY ALL"""


CTES["ids0"] = "SELECT 0 AS frame, s1_id FROM s1"
CTES["p0"] = "SELECT 0 AS frame, * FROM scored"
CTES["curve"] = _curve("ids0", "p0")
CTES["trn"] = "SELECT r.frame, s1_id FROM fold JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS frame) r ON r.frame <> fold"
CTES["own"] = "SELECT fold AS frame, s1_id FROM fold"
for _v in ("trn", "own"):
    CTES[f"p_{_v}"] = f"SELECT frame, s1_id, cand_id, p FROM scored JOIN {_v} USING (s1_id) QUALIFY row_number() OVER (PARTITION BY frame, cand_id ORDER BY p DESC, s1_id) = 1"
    CTES[f"curve_{_v}"] = _curve(_v, f"p_{_v}")
CTES["ltrn"] = "SELECT r.frame, s1_id FROM s1 JOIN (SELECT DISTINCT country_n AS frame FROM s1) r ON r.frame <> s1.country_n"
CTES["lown"] = "SELECT country_n AS frame, s1_id FROM s1"
for _v in ("ltrn", "lown"):
    CTES[f"p_{_v}"] = f"SELECT frame, s1_id, cand_id, p FROM scored JOIN {_v} USING (s1_id)"
    CTES[f"curve_{_v}"] = _curve(_v, f"p_{_v}")


def _with(final: str) -> str:
    """The query with the CTEs that it needs, in order."""
    import re

    need: list[str] = []
    seen: set[str] = set()

    def add(sql_text: str) -> None:
        for w in re.findall(r"\b[a-z]\w*\b", sql_text):
            if w in CTES and w not in seen and re.search(rf"\b(FROM|JOIN)\s+{w}\b", sql_text):
                seen.add(w)
                add(CTES[w])
                need.append(w)

    add(final)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in need) + "\n" + final if need else final


FINAL = {
    "norm_basic_clean": f"SELECT doc_id, {_clean('text')} AS clean FROM documents",
    "norm_names": "SELECT entity_id, name_n, name_core, country_n FROM norm",
    "norm_addr": "SELECT entity_id, addr_n, CAST(len(full_n) AS BIGINT) AS full_len FROM norm",
    "postal_numbers": "SELECT entity_id, array_to_string(list_sort(postal), ',') AS postal, array_to_string(list_sort(nums), ',') AS nums, postal1 FROM norm",
    "split_sources": "SELECT src, country, count(*) AS n, CAST(sum(len(addr)) AS BIGINT) AS chars FROM rec GROUP BY ALL",
    "doc_frequency": "SELECT country_n, tok, df FROM adf",
    "rare_tokens": "SELECT entity_id, country_n, tok, df, CAST(rank AS INTEGER) AS rank FROM nrare",
    "blocking_keys": "SELECT entity_id, country_n, scheme, key FROM keys",
    "oversized_keys": "SELECT country_n, scheme, key, n FROM blk WHERE n > 20",
    "blocking_join": "SELECT s1_id, cand_id FROM cand",
    "fallback_join": """SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cand_id FROM keys a JOIN keys b ON a.scheme = b.scheme AND a.key = b.key
  AND (a.country_n = 'es' OR a.country_n = CASE WHEN b.country_n = 'es' THEN 'fr' ELSE b.country_n END) WHERE a.entity_id LIKE 'S1%' AND b.entity_id NOT LIKE 'S1%'""",
    "exact_key_join": "SELECT s1_id, cand_id FROM exact",
    "exact_key_quality": """SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(n_pred) AS BIGINT) AS n_pred, CAST(sum(n_true) AS BIGINT) AS n_true,
  round(CASE WHEN sum(n_pred) = 0 THEN 1.0 ELSE sum(tp)::DOUBLE / sum(n_pred) END, 6) AS precision, round(CASE WHEN sum(n_true) = 0 THEN 1.0 ELSE sum(tp)::DOUBLE / sum(n_true) END, 6) AS recall FROM cexact""",
    "true_pairs": "SELECT s1_id, cand_id FROM truth",
    "truth_lists": "SELECT s1.s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS matched_entity_ids FROM s1 LEFT JOIN truth USING (s1_id) GROUP BY s1.s1_id",
    "tfidf_name": "SELECT entity_id, term, round(w, 6) AS w FROM post_name",
    "tfidf_addr": "SELECT entity_id, count(*) AS n_terms, round(sum(w), 6) AS sum_w FROM post_addr GROUP BY ALL",
    "tfidf_full": "SELECT entity_id, count(*) AS n_terms, round(sum(w), 6) AS sum_w FROM post_full GROUP BY ALL",
    "cosine_pairs": "SELECT s1_id, cand_id, cos_name, cos_addr, cos_full FROM cos",
    "topk_views": """SELECT 'cos_name' AS view, s1_id, cand_id, scheme, key FROM best3 WHERE rn <= 15 AND cos_name > 0 UNION ALL SELECT 'cos_full', s1_id, cand_id, scheme, key FROM best3 WHERE rf <= 15 AND cos_full > 0
  UNION ALL SELECT 'cos_addr', s1_id, cand_id, scheme, key FROM best3 WHERE ra <= 5 AND cos_addr > 0""",
    "topk_whole_group": """SELECT s1_id, cand_id, cos FROM (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, round(sum(a.w * b.w), 6) AS cos FROM post_name a JOIN post_name b USING (country_n, term)
  WHERE a.entity_id LIKE 'S1%' AND b.entity_id NOT LIKE 'S1%' GROUP BY ALL) WHERE cos > 0 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY cos DESC, cand_id) <= 5""",
    "cap_candidates": "SELECT s1_id, cand_id FROM cos QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY cos_full + cos_addr DESC, cand_id) <= 20",
    "cap_sweep": """SELECT cap, count(*) AS pairs, count(t.cand_id) AS hits FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, cand_id) AS rn FROM scored) x
  JOIN (SELECT unnest([1, 5, 20, 80]) AS cap) c ON rn <= cap LEFT JOIN truth t USING (s1_id, cand_id) GROUP BY ALL""",
    "context_features": """SELECT s1_id, cand_id, cos_name, cos_full, CASE WHEN cand_id LIKE 'S3%' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_s3, count(*) OVER (PARTITION BY s1_id) AS n_cands,
  CAST(rank() OVER (PARTITION BY s1_id ORDER BY cos_name DESC) AS INTEGER) AS rank_name_in_s1, round(max(cos_name) OVER (PARTITION BY s1_id) - cos_name, 6) AS gap_name_to_best,
  CAST(rank() OVER (PARTITION BY s1_id ORDER BY cos_full DESC) AS INTEGER) AS rank_full_in_s1, round(max(cos_full) OVER (PARTITION BY s1_id) - cos_full, 6) AS gap_full_to_best,
  CAST(rank() OVER (PARTITION BY country_n, cand_id ORDER BY cos_full DESC) AS INTEGER) AS rank_s1_for_cand, count(*) OVER (PARTITION BY country_n, cand_id) AS n_s1_for_cand,
  round(max(cos_full) OVER (PARTITION BY country_n, cand_id) - cos_full, 6) AS gap_to_best_s1_for_cand FROM cos""",
    "set_features": """SELECT s1_id, cand_id, CASE WHEN len(p) = 0 OR len(q) = 0 THEN -1.0 WHEN list_has_any(p, q) THEN 1.0 ELSE 0.0 END::DOUBLE AS postal_match,
  CASE WHEN len(n) + len(m) = 0 THEN -1.0 ELSE round(len(list_intersect(n, m))::DOUBLE / (len(n) + len(m) - len(list_intersect(n, m))), 6) END::DOUBLE AS num_jacc, len(list_intersect(n, m))::DOUBLE AS num_overlap
  FROM (SELECT s1_id, cand_id, list_distinct(list_transform(a.postal, lambda x: CAST(x AS HUGEINT))) AS p, list_distinct(list_transform(b.postal, lambda x: CAST(x AS HUGEINT))) AS q,
  list_distinct(list_transform(a.nums, lambda x: CAST(x AS HUGEINT))) AS n, list_distinct(list_transform(b.nums, lambda x: CAST(x AS HUGEINT))) AS m FROM cand JOIN norm a ON a.entity_id = s1_id JOIN norm b ON b.entity_id = cand_id)""",
    "scalar_features": """SELECT s1_id, cand_id, CASE WHEN split_part(a.name_core, ' ', 1) = split_part(b.name_core, ' ', 1) THEN 1.0 ELSE 0.0 END::DOUBLE AS core_first_tok_eq,
  abs(len(a.name_core) - len(b.name_core))::DOUBLE AS core_len_diff FROM cand JOIN norm a ON a.entity_id = s1_id JOIN norm b ON b.entity_id = cand_id""",
    "jaro_winkler": """SELECT s1_id, cand_id, round(jaro_winkler_similarity(a.name_n, b.name_n), 6) AS nm_jw, round(jaro_winkler_similarity(a.name_core, b.name_core), 6) AS core_jw
  FROM cand JOIN norm a ON a.entity_id = s1_id JOIN norm b ON b.entity_id = cand_id""",
    "label_pairs": "SELECT s1_id, cand_id, CASE WHEN t.cand_id IS NULL THEN 0 ELSE 1 END AS y FROM cand LEFT JOIN truth t USING (s1_id, cand_id)",
    "scored_pairs": "SELECT s1_id, cand_id, p FROM scored",
    "blocking_report": """SELECT CAST(sum(n_pred) AS BIGINT) AS pairs, round(sum(tp)::DOUBLE / sum(n_true), 6) AS pair_recall, round(avg(CASE WHEN n_true > 0 THEN CASE WHEN tp = n_true THEN 1.0 ELSE 0.0 END END), 6) AS entity_cover,
  round(avg(n_pred), 6) AS per_entity, round(avg(CASE WHEN n_true = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25::DOUBLE * (tp::DOUBLE / n_true) / (0.25::DOUBLE + tp::DOUBLE / n_true) END), 6) AS oracle_f05 FROM ccand""",
    "scheme_contribution": """SELECT scheme, count(*) AS true_pairs, count(*) FILTER (n = 1) AS unique_true FROM (SELECT *, count(*) OVER (PARTITION BY s1_id, cand_id) AS n
  FROM (SELECT DISTINCT kp.s1_id, kp.cand_id, scheme FROM kp JOIN truth t ON t.s1_id = kp.s1_id AND t.cand_id = kp.cand_id)) GROUP BY ALL""",
    "candidate_quantiles": """SELECT round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, max(n) AS most, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS sd
  FROM (SELECT s1_id, count(*) AS n FROM cand GROUP BY ALL)""",
    "folds": "SELECT s1_id, fold FROM fold",
    "fold_scores": f"SELECT fold, count(*) AS n, round(avg({F05}), 6) AS macro_f05 FROM c50 JOIN fold USING (s1_id) GROUP BY ALL",
    "threshold_rule": "SELECT s1_id, cand_id, p FROM rule50",
    "one_to_one_rule": "SELECT s1_id, cand_id, p FROM rule50o",
    "relative_rule": "SELECT s1_id, cand_id, p FROM (SELECT *, max(p) OVER (PARTITION BY s1_id) AS best FROM rule30o) WHERE p >= 0.9::DOUBLE * best",
    "adaptive_rule": """SELECT s1_id, cand_id, p FROM (SELECT *, count(*) OVER (PARTITION BY s1_id) AS n FROM scored) WHERE p >= 0.4::DOUBLE + 0.05::DOUBLE * (ln(1 + n) - ln(9))
  QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, s1_id) = 1""",
    "expected_f05_rule": "SELECT s1_id, cand_id, p FROM expected",
    "contested_share": "SELECT count(*) AS records, round(coalesce(avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END), 0.0), 6) AS share FROM (SELECT cand_id, count(DISTINCT s1_id) AS n FROM rule30 GROUP BY ALL)",
    "one_to_one_check": "SELECT *, share < 0.01 AS one_to_one FROM (SELECT count(*) AS records, round(coalesce(avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END), 0.0), 6) AS share FROM (SELECT cand_id, count(*) AS n FROM truth GROUP BY ALL))",
    "exact_key_augment": """WITH kept AS (SELECT s1_id, cand_id FROM scored WHERE p >= 0.9 QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, s1_id) = 1)
  SELECT s1_id, cand_id FROM kept UNION ALL (SELECT s1_id, cand_id FROM exact WHERE cand_id NOT IN (SELECT cand_id FROM kept) QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY s1_id) = 1)""",
    "threshold_curve": "SELECT t, macro_f05 FROM curve",
    "best_threshold": "SELECT t, macro_f05 FROM curve ORDER BY macro_f05 DESC, t LIMIT 1",
    "cross_fitted": """SELECT o.frame AS fold, o.t, o.macro_f05 FROM curve_own o JOIN (SELECT frame, t FROM curve_trn QUALIFY row_number() OVER (PARTITION BY frame ORDER BY macro_f05 DESC, t) = 1) b ON b.frame = o.frame AND b.t = o.t""",
    "loco_threshold": """SELECT o.frame AS country_n, o.t, o.macro_f05 FROM curve_lown o JOIN (SELECT frame, t FROM curve_ltrn QUALIFY row_number() OVER (PARTITION BY frame ORDER BY macro_f05 DESC, t) = 1) b ON b.frame = o.frame AND b.t = o.t""",
    "id_lists": "SELECT s1.s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS matched_entity_ids FROM s1 LEFT JOIN rule50o USING (s1_id) GROUP BY s1.s1_id",
    "country_audit": """SELECT country_n, count(*) AS n, count(*) FILTER (n_pred > 0) AS nonempty, CAST(sum(n_pred) AS BIGINT) AS matched, round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 0.0 END), 6) AS singletons FROM c50o GROUP BY ALL""",
    "pair_set_comparison": """SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS both, count(*) FILTER (b IS NULL) AS only_a, count(*) FILTER (a IS NULL) AS only_b,
  round(count(*) FILTER (a IS NOT NULL AND b IS NOT NULL)::DOUBLE / greatest(count(*), 1), 6) AS jaccard FROM (SELECT s1_id, cand_id, 1 AS a FROM rule50o) x FULL JOIN (SELECT s1_id, cand_id, 1 AS b FROM expected) y USING (s1_id, cand_id)""",
    "linkage_macro_f05": f"""SELECT count(*) AS entities, round(avg({F05}), 6) AS macro_f05, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(n_pred) AS BIGINT) AS n_pred, CAST(sum(n_true) AS BIGINT) AS n_true,
  round(CASE WHEN sum(n_pred) = 0 THEN 1.0 ELSE sum(tp)::DOUBLE / sum(n_pred) END, 6) AS precision, round(CASE WHEN sum(n_true) = 0 THEN 1.0 ELSE sum(tp)::DOUBLE / sum(n_true) END, 6) AS recall FROM clink""",
}
CTES["link80"] = "SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, cand_id) <= 80"
CTES["link50"] = "SELECT s1_id, cand_id, p FROM link80 WHERE p >= 0.5 QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, s1_id) = 1"
CTES["clink"] = _counts("link50")
CTES["lk"] = """SELECT s1_id, cand_id, m, row_number() OVER o AS k, count(*) OVER w AS n, sum(m) OVER w AS total, max(m) OVER w AS best, exp(sum(ln(1 - least(p, 1 - 1e-12))) OVER w) AS p_empty,
  count(*) FILTER (m >= 500000) OVER w AS n50, count(*) FILTER (m >= 800000) OVER w AS n80, sum(m) OVER (o ROWS UNBOUNDED PRECEDING) AS cum, sum(y) OVER (o ROWS UNBOUNDED PRECEDING) AS tp
  FROM (SELECT s1_id, cand_id, p, CAST(round(p * 1000000) AS BIGINT) AS m, CASE WHEN t.cand_id IS NULL THEN 0 ELSE 1 END AS y FROM scored LEFT JOIN truth t USING (s1_id, cand_id))
  WINDOW w AS (PARTITION BY s1_id), o AS (PARTITION BY s1_id ORDER BY m DESC, cand_id)"""
CTES["lk2"] = """SELECT s1_id, k, n, CAST(total AS BIGINT) AS total, best, p_empty, n50, n80, CAST(cum AS BIGINT) AS cum, CAST(tp AS BIGINT) AS tp, m FROM lk WHERE k <= 12
  UNION ALL SELECT s1_id, 0, n, CAST(total AS BIGINT), best, p_empty, n50, n80, 0, 0, 0 FROM lk WHERE k = 1"""
FINAL["learn_k_rows"] = f"""SELECT s1_id, CAST(k AS BIGINT) AS k, n AS n_cands, {_ratio("k", "n")} AS k_frac, cum / 1e6::DOUBLE AS cum_p, m / 1e6::DOUBLE AS p_k, best / 1e6::DOUBLE AS p1, (best - m) / 1e6::DOUBLE AS gap_1k,
  {_ratio("cum", "greatest(k, 1) * 1000000")} AS mean_top_k, total / 1e6::DOUBLE AS sum_p, round(p_empty, 6) AS p_empty, CASE WHEN k = 0 THEN round(p_empty, 6) ELSE {_ratio("5 * cum", "total + greatest(k, 1) * 4000000")} END AS exp_f05,
  n50 AS n_above_50, n80 AS n_above_80, CASE WHEN coalesce(n_true, 0) = 0 AND k = 0 THEN 1.0 WHEN coalesce(n_true, 0) = 0 OR tp = 0 THEN 0.0 ELSE {_ratio("5 * tp", "coalesce(n_true, 0) + 4 * greatest(k, 1)")} END::DOUBLE AS target
  FROM lk2 LEFT JOIN nt USING (s1_id)"""
CTES["best3"] = """SELECT kp.s1_id, kp.cand_id, scheme, key, cos_name, cos_full, cos_addr, row_number() OVER (b ORDER BY cos_name DESC, kp.cand_id) AS rn, row_number() OVER (b ORDER BY cos_full DESC, kp.cand_id) AS rf,
  row_number() OVER (b ORDER BY cos_addr DESC, kp.cand_id) AS ra FROM kp JOIN cos ON cos.s1_id = kp.s1_id AND cos.cand_id = kp.cand_id WINDOW b AS (PARTITION BY kp.s1_id, scheme, key)"""
CTES["gen"] = """SELECT s1_id, cand_id, cos_name, cos_full, cos_addr FROM (SELECT DISTINCT s1_id, cand_id, cos_name, cos_full, cos_addr FROM best3
  WHERE (rn <= 15 AND cos_name > 0) OR (rf <= 15 AND cos_full > 0) OR (ra <= 5 AND cos_addr > 0)) QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY cos_full + cos_addr DESC, cand_id) <= 80"""
FINAL["generate_candidates"] = "SELECT s1_id, cand_id, cos_name, cos_full, cos_addr FROM gen"


# the outputs of verify_outputs, spoilt in the same way
CTES["lm"] = "SELECT row_number() OVER (ORDER BY s1.s1_id) AS n, s1.s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids FROM s1 LEFT JOIN rule50o USING (s1_id) GROUP BY s1.s1_id"
CTES["lc"] = "SELECT row_number() OVER (ORDER BY s1.s1_id) AS n, s1.s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids FROM s1 LEFT JOIN scored USING (s1_id) GROUP BY s1.s1_id"
CTES["xm"] = """SELECT n, CASE WHEN n % 25 = 9 THEN 'S1-0' ELSE s1_id END AS ms, list_filter(string_split(CASE WHEN n % 10 = 3 THEN ids || ',' || ids WHEN n % 10 = 5 THEN ids || ',S9-1' WHEN n % 10 = 7 THEN ids || ',S2-none' ELSE ids END, ','),
  lambda x: x <> '') AS m FROM lm WHERE n % 25 <> 11"""
CTES["xc"] = "SELECT n, s1_id AS cs, list_filter(string_split(CASE WHEN n % 10 = 8 THEN ids || ',S3-none' ELSE ids END, ','), lambda x: x <> '') AS c FROM lc UNION ALL SELECT n + 1000000000, s1_id, list_filter(string_split(ids, ','), lambda x: x <> '') FROM lc WHERE n = 1"
CTES["xr"] = "SELECT * FROM lm l FULL JOIN xm ON xm.n = l.n FULL JOIN xc ON xc.n = coalesce(l.n, xm.n)"
FINAL["verify_outputs"] = """SELECT 'missing_rows' AS "check", count(*) FILTER (s1_id IS NOT NULL AND (ms IS NULL OR cs IS NULL)) AS bad FROM xr
  UNION ALL SELECT 'extra_rows', count(*) FILTER (s1_id IS NULL) FROM xr UNION ALL SELECT 'misaligned', count(*) FILTER (s1_id IS NOT NULL AND (ms <> s1_id OR cs <> s1_id)) FROM xr
  UNION ALL SELECT 'dup_in_list', count(*) FROM xm WHERE len(list_distinct(m)) < len(m)
  UNION ALL SELECT 'not_in_candidates', count(*) FROM xm LEFT JOIN xc USING (n) WHERE NOT list_has_all(coalesce(c, []), m)
  UNION ALL SELECT 'bad_prefix', count(*) FROM (SELECT unnest(m) AS i FROM xm) WHERE i NOT LIKE 'S2-%' AND i NOT LIKE 'S3-%'
  UNION ALL SELECT 'unknown_ids', count(*) FROM (SELECT unnest(c) AS i FROM xc) WHERE i NOT IN (SELECT entity_id FROM norm WHERE src <> 'S1')
  UNION ALL SELECT 'repeated_entities', count(*) FROM (SELECT ms FROM xm GROUP BY ms HAVING count(*) > 1)"""
CTES["rate"] = "SELECT country_n, count(*) AS n, count(*) FILTER (n_pred > 0) AS k FROM c50o GROUP BY ALL"
CTES["rule90o"] = "SELECT s1_id, cand_id, p FROM scored WHERE p >= 0.9 QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, s1_id) = 1"
CTES["rates"] = """SELECT sum(k)::DOUBLE / greatest(sum(n), 1) AS share, max(k::DOUBLE / n) FILTER (country_n = 'fr') AS fr, min(k::DOUBLE / n) FILTER (country_n <> 'fr') AS lo, max(k::DOUBLE / n) FILTER (country_n <> 'fr') AS hi,
  (SELECT count(DISTINCT s1_id) FROM rule90o)::DOUBLE / (SELECT count(*) FROM s1) AS ref FROM rate"""
FINAL["rate_audit"] = """SELECT *, coalesce(value >= low AND value <= high, false) AS ok FROM (SELECT 'share_gap' AS "check", round(abs(share - ref), 6) AS value, 0.0::DOUBLE AS low, 0.05::DOUBLE AS high FROM rates
  UNION ALL SELECT 'unseen_not_collapsed', round(fr, 6), round(0.8::DOUBLE * coalesce(lo, 0.0), 6), 1.0::DOUBLE FROM rates UNION ALL SELECT 'unseen_not_inflated', round(fr, 6), 0.0::DOUBLE, round(1.3::DOUBLE * coalesce(hi, 1.0), 6) FROM rates)"""
FINAL["empty_baseline"] = "SELECT round(avg(CASE WHEN n_true IS NULL THEN 1.0 ELSE 0.0 END), 6) AS singletons, round(avg(CASE WHEN n_true IS NULL THEN 1.0 ELSE 0.0 END), 6) AS macro_f05 FROM s1 LEFT JOIN nt USING (s1_id)"
FINAL["modal_threshold"] = f"SELECT t, count(*) AS n FROM ({FINAL['cross_fitted']}) GROUP BY t ORDER BY n DESC, min(fold) LIMIT 1"
FINAL["row_count"] = "SELECT count(*) AS rows FROM documents"
FINAL["country_slice"] = "SELECT doc_id, source FROM documents WHERE lang = 'fr'"
CTES["srt"] = """SELECT s1_id, cand_id, cos_name, cos_full, cos_addr, unnest([{'s': 'max', 'v': greatest(cos_name, cos_full, cos_addr)}, {'s': 'sum', 'v': round(cos_name + cos_full + cos_addr, 6)}, {'s': 'cos_full', 'v': cos_full},
  {'s': 'full_addr', 'v': round(cos_full + cos_addr, 6)}]) AS x FROM cos"""
CTES["srk"] = "SELECT s1_id, cand_id, x.s AS score, row_number() OVER (PARTITION BY x.s, s1_id ORDER BY x.v DESC, cand_id) AS r FROM srt"
CTES["sch"] = """SELECT g.score, g.cap, g.s1_id, coalesce(n_true, 0) AS n_true, count(h.cand_id) AS h FROM (SELECT s1_id, score, cap FROM s1 CROSS JOIN (SELECT unnest(['max', 'sum', 'cos_full', 'full_addr']) AS score)
  CROSS JOIN (SELECT unnest([20, 40, 60, 80, 100, 150, 0]) AS cap)) g LEFT JOIN nt ON nt.s1_id = g.s1_id LEFT JOIN (SELECT k.* FROM srk k JOIN truth t ON t.s1_id = k.s1_id AND t.cand_id = k.cand_id) h
  ON h.s1_id = g.s1_id AND h.score = g.score AND (h.r <= g.cap OR g.cap = 0) GROUP BY ALL"""
FINAL["cap_sweep_scores"] = """SELECT score, cap, CAST(sum(h) AS BIGINT) AS hits, round(sum(h)::DOUBLE / nullif(sum(n_true), 0), 6) AS recall, round(avg(CASE WHEN h = n_true THEN 1.0 ELSE 0.0 END), 6) AS cover,
  round(avg(CASE WHEN n_true = 0 THEN 1.0 WHEN h = 0 THEN 0.0 ELSE 1.25::DOUBLE * (h::DOUBLE / n_true) / (0.25::DOUBLE + h::DOUBLE / n_true) END), 6) AS oracle_f05 FROM sch GROUP BY ALL"""
CTES["wrl"] = "SELECT 't' || frame AS frame, s1_id FROM trn UNION ALL SELECT 'v' || frame, s1_id FROM own"
CTES["rgd"] = "SELECT unnest([{'choice': 0, 't': 0.3::DOUBLE, 'a': 0.5::DOUBLE}, {'choice': 1, 't': 0.3::DOUBLE, 'a': 0.9::DOUBLE}, {'choice': 2, 't': 0.5::DOUBLE, 'a': 0.5::DOUBLE}, {'choice': 3, 't': 0.5::DOUBLE, 'a': 0.9::DOUBLE}], recursive := true)"
CTES["rkp"] = """SELECT frame, choice, s1_id, cand_id FROM (SELECT *, max(p) OVER (PARTITION BY choice, frame, s1_id) AS best FROM (SELECT frame, choice, a, s1_id, cand_id, p FROM scored JOIN wrl USING (s1_id) JOIN rgd ON p >= t
  QUALIFY row_number() OVER (PARTITION BY choice, frame, cand_id ORDER BY p DESC, s1_id) = 1)) WHERE p >= a * best"""
CTES["rsc"] = f"""SELECT frame, choice, round(avg({F05}), 6) AS macro_f05 FROM (SELECT w.frame, w.s1_id, g.choice, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS n_true FROM wrl w CROSS JOIN rgd g
  LEFT JOIN (SELECT x.frame, x.s1_id, x.choice, count(*) AS n_pred, count(tr.cand_id) AS tp FROM rkp x LEFT JOIN truth tr USING (s1_id, cand_id) GROUP BY ALL) y USING (frame, s1_id, choice) LEFT JOIN nt USING (s1_id)) GROUP BY ALL"""
FINAL["rule_choice"] = """SELECT CAST(substring(v.frame, 2) AS INTEGER) AS fold, v.choice, v.macro_f05 FROM rsc v JOIN (SELECT frame, choice FROM rsc WHERE frame LIKE 't%' QUALIFY row_number() OVER (PARTITION BY frame ORDER BY macro_f05 DESC, choice) = 1) b
  ON substring(b.frame, 2) = substring(v.frame, 2) AND b.choice = v.choice WHERE v.frame LIKE 'v%'"""
CTES["sub1"] = "SELECT s1_id AS entity_id FROM s1 ORDER BY md5('42|' || s1_id), s1_id LIMIT 40"
CTES["subt"] = "SELECT DISTINCT cand_id AS entity_id FROM truth JOIN sub1 ON sub1.entity_id = s1_id"
CTES["subo"] = """SELECT entity_id, row_number() OVER (ORDER BY md5('42|' || entity_id), entity_id) AS r FROM norm WHERE src <> 'S1' AND entity_id NOT IN (SELECT entity_id FROM subt)"""
CTES["subn"] = "SELECT CAST(round(40 * (SELECT count(*) FROM norm WHERE src <> 'S1')::DOUBLE / (SELECT count(*) FROM s1)) AS BIGINT) - (SELECT count(*) FROM subt) AS k"
FINAL["subsample"] = "SELECT entity_id FROM sub1 UNION ALL SELECT entity_id FROM subt UNION ALL SELECT entity_id FROM subo JOIN subn ON r <= k"
FINAL["pair_sample"] = """SELECT s1_id, cand_id FROM cand WHERE CAST('0x' || left(md5('42|' || s1_id || '|' || cand_id), 8) AS BIGINT) % 1000000
  < (SELECT round(1000000 * least(1.0::DOUBLE, floor(count(*) / 4)::DOUBLE / count(*))) FROM cand)"""
# the longest common subsequence: a row of the table a step, each value the largest so far of what the row before allows
for _v in ("name_n", "name_core"):
    CTES[f"lcs_{_v}"] = f"""SELECT a, b, 0 AS i, list_transform(range(0, len(b) + 1), lambda x: 0) AS r FROM (SELECT DISTINCT x.{_v} AS a, y.{_v} AS b FROM cand JOIN norm x ON x.entity_id = s1_id JOIN norm y ON y.entity_id = cand_id)
  UNION ALL SELECT a, b, i + 1, list_concat([0], list_transform(range(1, len(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN a[i + 1] = b[k] THEN r[k] + 1 ELSE r[k + 1] END)))) FROM lcs_{_v} WHERE i < len(a)"""
    CTES[f"rat_{_v}"] = f"SELECT a, b, CASE WHEN len(a) + len(b) = 0 THEN 100.0 ELSE round(200.0::DOUBLE * r[len(b) + 1] / (len(a) + len(b)), 6) END::DOUBLE AS q FROM lcs_{_v} WHERE i = len(a)"
FINAL["name_ratios"] = """SELECT s1_id, cand_id, p.q AS nm_ratio, c.q AS core_ratio FROM cand JOIN norm x ON x.entity_id = s1_id JOIN norm y ON y.entity_id = cand_id
  JOIN rat_name_n p ON p.a = x.name_n AND p.b = y.name_n JOIN rat_name_core c ON c.a = x.name_core AND c.b = y.name_core"""
# greedy matching one pair after the other
CTES["rule80o"] = "SELECT s1_id, cand_id, p FROM scored WHERE p >= 0.8 QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, s1_id) = 1"
CTES["ord"] = """SELECT s1_id, cand_id, p, row_number() OVER (ORDER BY p DESC, s1_id, cand_id) AS rn FROM scored WHERE p >= 0.2 AND s1_id NOT IN (SELECT s1_id FROM rule80o) AND cand_id NOT IN (SELECT cand_id FROM rule80o)"""
CTES["walk"] = """SELECT 0::BIGINT AS i, []::VARCHAR[] AS us, []::VARCHAR[] AS uc UNION ALL SELECT i + 1, CASE WHEN list_contains(us, s1_id) OR list_contains(uc, cand_id) THEN us ELSE list_append(us, s1_id) END,
  CASE WHEN list_contains(us, s1_id) OR list_contains(uc, cand_id) THEN uc ELSE list_append(uc, cand_id) END FROM walk JOIN ord ON rn = i + 1"""
CTES["won"] = "SELECT unnest(us) AS s1_id, unnest(uc) AS cand_id FROM (SELECT us, uc FROM walk ORDER BY i DESC LIMIT 1)"
FINAL["top1_rule"] = "SELECT s1_id, cand_id, p FROM rule80o UNION ALL SELECT s1_id, cand_id, p FROM won JOIN scored USING (s1_id, cand_id)"


def oracles() -> dict[str, str]:
    out = {}
    for name, final in FINAL.items():
        if final.startswith("WITH "):  # a CTE of its own after the shared ones
            head = _with(final[5:])
            out[name] = head.replace("\nkept AS", ",\nkept AS", 1)
        else:
            out[name] = _with(final)
    return out
