"""SQL for a second engine, one statement per registered query, written from the operators' definitions."""

from textassay.functions import minhash as M
from textassay.operators.scorecard import ADVICE, TITLES

# Metric limits, spelled out so that a wrong one in the library shows.
LIMITS = {"MI-01": (10.0, ">"), "MI-02": (2.0, ">"), "MI-03": (5.0, ">"), "MI-04": (80.0, "<")}

# Unicode whitespace, spelled out: \\s is ASCII only here.
SPACE_CHARS = (
    r"\t\n\x0b\x0c\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
W = f"[{SPACE_CHARS}]"
NON_WORD = r"[^\p{L}\p{N}_]"
TAG = "<[^>]*>"

# The patterns in full, not in the shortened form the library searches for.
PII = {
    "email": r"[a-zA-ZıİſK0-9._%+\-]+@[a-zA-ZıİſK0-9.\-]+\.[a-zA-ZıİſK]{2,}",
    "telefono": rf"(\+57|57)?{W}*(3[0-9]{{2}}|60[1-8]){W}*[0-9]{{3}}{W}*[0-9]{{4}}",
    "ipv4": rf"(^|{NON_WORD})((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){{3}}(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)($|{NON_WORD})",
    "cedula": rf"(^|{NON_WORD})([1-9][0-9]{{2,3}}(\.[0-9]{{3}}){{2}}|[1-9][0-9]{{7,9}})($|{NON_WORD})",
    "credenciales_url": rf"https?://[^{SPACE_CHARS}:@]+:[^{SPACE_CHARS}:@]+@[^{SPACE_CHARS}/]+",
}
FALSE_HITS = {
    "email": (0.03, "< 3%"),
    "telefono": (0.18, "~18%"),
    "ipv4": (0.42, "~42%"),
    "cedula": (0.65, "> 65%"),
    "credenciales_url": (0.12, "~12%"),
}
PII_ANY = " OR ".join(f"pii_{c}" for c in PII)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{W}+', ' ', 'g'))"


def strip(x: str) -> str:
    return squeeze(f"regexp_replace(coalesce({x}, ''), '{TAG}', ' ', 'g')")


def ratio(x: str) -> str:
    return f"CASE WHEN length({x}) > 0 THEN (length({x}) - length(regexp_replace({x}, '{TAG}', '', 'g'))) / CAST(length({x}) AS DOUBLE) ELSE 0.0 END"


def normalize(x: str) -> str:
    return squeeze(rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}{SPACE_CHARS}]', '', 'g')")


def tokens(x: str) -> str:
    kept = f"regexp_replace(lower(coalesce({x}, '')), '[^a-záéíóúüñ0-9{SPACE_CHARS}]', '', 'g')"
    return f"list_filter(string_split_regex({kept}, '{W}+'), lambda w: w <> '')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_replace({x}, '{W}', '', 'g') = '')"


def reason(clean: str, raw: str) -> str:
    return f"CASE WHEN {ratio(raw)} > 0.3 THEN 'html' WHEN length({clean}) < 100 THEN 'short' WHEN {blank(clean)} THEN 'empty' END"


def pct(part: str, whole: str) -> str:
    return f"coalesce(CAST(100 AS DOUBLE) * {part} / nullif({whole}, 0), 0)"


# The default list, spelled out here so that a change of the library's would show.
TERMS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless".split()
LEXICON = "lexicon(term, w) AS (VALUES " + ", ".join(f"({quoted(t)}, {100 * len(t)})" for t in TERMS) + ")"


def scored(source: str, terms: str | None = None) -> str:
    """CTEs ending in scored(doc_id, tox_millis, n_tokens, tox_score) of source(doc_id, text)."""
    return f"""{terms or LEXICON},
    toks AS (SELECT doc_id, {tokens("text")} AS t FROM {source}),
    words AS (SELECT doc_id, unnest(t) AS term FROM toks),
    hits AS (SELECT doc_id, sum(w) AS s FROM words JOIN lexicon USING (term) GROUP BY doc_id),
    sums AS (SELECT doc_id, CAST(coalesce(s, 0) AS BIGINT) AS tox_millis, CAST(len(t) AS BIGINT) AS n_tokens
             FROM toks LEFT JOIN hits USING (doc_id)),
    scored AS (SELECT *, CASE WHEN n_tokens > 0 THEN ((2000 * tox_millis + n_tokens) // (2 * n_tokens)) / CAST(1000000 AS DOUBLE)
                              ELSE 0.0 END AS tox_score FROM sums)"""


MEAN = "coalesce(CAST(sum(CAST(tox_score AS DECIMAL(18,6))) AS DOUBLE) / nullif(count(*), 0), 0)"


def flagged(source: str) -> str:
    columns = ", ".join(f"coalesce(regexp_matches(text, '{p}'), false) AS pii_{c}" for c, p in PII.items())
    return f"flags AS (SELECT doc_id, {columns} FROM {source}), flagged AS (SELECT *, ({PII_ANY}) AS pii_any FROM flags)"


def shingle_list(t: str, n: int = 5) -> str:
    chars = f"string_split({t}, '')"
    gram = " || ".join(f"c[i + {j}]" if j else "c[i]" for j in range(n))
    return f"""(SELECT CASE WHEN length({t}) < {n} THEN [{t}]
        ELSE list_distinct(list_transform(range(1, len(c) - {n - 2}), lambda i: {gram})) END FROM (SELECT {chars} AS c))"""


def signatures(source: str, n: int = 5, num_perm: int = 128) -> str:
    """CTEs ending in sig(doc_id, k, m) of source(doc_id, text)."""
    mask = 2**32 - 1

    def fold(codes: list[str]) -> str:
        h = str(M.SEED)
        for c in codes:
            h = f"(({h} * {M.RADIX} + {c}) & {mask})"
        return h

    gram = fold([f"c[i + {j}]" if j else "c[i]" for j in range(n)])
    short = "CASE len(c) " + " ".join(
        f"WHEN {k} THEN {fold([f'c[{j + 1}]' for j in range(k)])}" for k in range(n)
    ) + " END"
    return f"""norm AS (SELECT doc_id, {normalize("text")} AS t FROM {source}),
    codes AS (SELECT doc_id, CASE WHEN t = '' THEN [] ELSE list_transform(string_split(t, ''), lambda x: CAST(unicode(x) AS BIGINT)) END AS c FROM norm),
    grams AS (SELECT doc_id, CASE WHEN len(c) < {n} THEN [{short}] ELSE list_distinct(list_transform(range(1, len(c) - {n - 2}), lambda i: {gram})) END AS hs FROM codes),
    h0 AS (SELECT doc_id, CAST(unnest(hs) AS BIGINT) AS h FROM grams),
    h1 AS (SELECT doc_id, xor(h, h >> 16) AS h FROM h0),
    h2 AS (SELECT doc_id, (h * {M.MIX_1}) & {mask} AS h FROM h1),
    h3 AS (SELECT doc_id, xor(h, h >> 15) AS h FROM h2),
    h4 AS (SELECT doc_id, (h * {M.MIX_2}) & {mask} AS h FROM h3),
    hashed AS (SELECT doc_id, xor(h, h >> 16) AS h FROM h4),
    perms AS (SELECT CAST(k AS INTEGER) AS k, (CAST('0x' || substr(md5('a' || k), 1, 8) AS BIGINT) >> 1) | 1 AS a,
                     CAST('0x' || substr(md5('b' || k), 1, 8) AS BIGINT) AS b FROM range({num_perm}) r(k)),
    sig AS (SELECT doc_id, k, min((a * h + b) & {mask}) >> 1 AS m FROM hashed, perms GROUP BY doc_id, k)"""


def bands(source: str) -> str:
    return f"""{signatures(source)},
    bands AS (SELECT doc_id, k // 8 AS band,
                     CAST('0x' || substr(md5((k // 8) || ',' || string_agg(m, ',' ORDER BY k)), 1, 15) AS BIGINT) AS band_key
              FROM sig GROUP BY doc_id, k // 8)"""


def candidates(source: str) -> str:
    return f"""{bands(source)},
    cand AS (SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM bands a JOIN bands b
             ON a.band = b.band AND a.band_key = b.band_key AND a.doc_id < b.doc_id)"""


def pairs(source: str) -> str:
    return f"""{candidates(source)},
    agree AS (SELECT doc_a, doc_b, count(*) AS matches FROM cand
              JOIN sig a ON a.doc_id = doc_a JOIN sig b ON b.doc_id = doc_b AND a.k = b.k AND a.m = b.m GROUP BY ALL),
    pairs AS (SELECT doc_a, doc_b, round_even(matches / CAST(128 AS DOUBLE), 4) AS jaccard FROM agree WHERE matches >= 103)"""


def groups(source: str) -> str:
    """CTEs ending in members(doc_id, rep, copies) of documents with equal signatures."""
    return f"""{pairs(source)},
    whole AS (SELECT doc_id, string_agg(m, ',' ORDER BY k) AS signature FROM sig GROUP BY doc_id),
    members AS (SELECT doc_id, min(doc_id) OVER same AS rep, count(*) OVER same AS copies FROM whole WINDOW same AS (PARTITION BY signature))"""


def dup_summary(source: str) -> str:
    return f"""{pairs(source)},
    dups AS (SELECT (SELECT count(*) FROM {source}) AS total_docs, (SELECT count(*) FROM pairs) AS total_pairs,
                    (SELECT count(*) FROM (SELECT doc_a FROM pairs UNION SELECT doc_b FROM pairs)) AS dup_docs)"""


def stats(source: str) -> str:
    """CTEs ending in stats, one row, of source(doc_id, text)."""
    return f"""{scored(source)}, {flagged(source)},
    stats AS (SELECT count(*) AS total_docs, count(*) FILTER (pii_any) AS pii_docs,
        {pct("count(*) FILTER (pii_any)", "count(*)")} AS pct_pii, {MEAN} AS mean_score,
        count(*) FILTER (tox_score > 0.5) AS toxic_docs, {pct("count(*) FILTER (tox_score > 0.5)", "count(*)")} AS pct_toxic
        FROM scored JOIN flagged USING (doc_id))"""


def scorecard(all_rows: str) -> str:
    """CTEs ending in judged (tidy scorecard with advice) of all_rows(doc_id, text, raw)."""

    def row(name: str, value: str, mean: str, hits: str, total: str) -> str:
        title, method = TITLES[name]
        limit, direction = LIMITS[name]
        return f"""SELECT {quoted(name)} AS metric, {quoted(title)} AS title, {value} AS exact_value, {mean} AS score_mean,
            '%' AS unit, {quoted(method)} AS method, CAST({limit} AS DOUBLE) AS threshold, {quoted(direction)} AS direction,
            CAST({hits} AS BIGINT) AS n_hits, CAST({total} AS BIGINT) AS n_total FROM figures"""

    def advice(part: int) -> str:
        cases = []
        for name, (alert, ok) in ADVICE.items():
            text = quoted(alert[part])
            if part:
                text = f"replace({text}, '%s', printf('%.2f%%', round_even(exact_value, 2)))"
            cases.append(f"WHEN metric = '{name}' AND status = 'ALERT' THEN {text} WHEN metric = '{name}' THEN {quoted(ok[part])}")
        return "CASE " + " ".join(cases) + " END"

    rows = " UNION ALL ".join(
        [
            row("MI-01", f"round_even({pct('total_pairs', 'dup_total')}, 2)", "CAST(NULL AS DOUBLE)", "total_pairs", "dup_total"),
            row("MI-02", "pct_pii", "CAST(NULL AS DOUBLE)", "pii_docs", "total_docs"),
            row("MI-03", "pct_toxic", "round_even(mean_score, 4)", "toxic_docs", "total_docs"),
            row("MI-04", pct("total_docs", "total_rows"), "CAST(NULL AS DOUBLE)", "total_docs", "total_rows"),
        ]
    )
    return f"""cleaned AS (SELECT doc_id, text FROM {all_rows} WHERE ({reason("text", "raw")}) IS NULL),
    {dup_summary("cleaned")}, {stats("cleaned")},
    figures AS (SELECT stats.*, dups.total_docs AS dup_total, total_pairs, (SELECT count(*) FROM {all_rows}) AS total_rows FROM stats, dups),
    tidy AS ({rows}),
    judged0 AS (SELECT *, CASE WHEN (direction = '>' AND exact_value > threshold) OR (direction = '<' AND exact_value < threshold)
                               THEN 'ALERT' ELSE 'OK' END AS status FROM tidy),
    judged AS (SELECT *, round_even(exact_value, 2) AS value, {advice(0)} AS code, {advice(1)} AS message FROM judged0)"""


METRIC_COLUMNS = "metric, title, value, score_mean, unit, method, threshold, direction, n_hits, n_total"
DOCS = "docs AS (SELECT doc_id, text, text AS raw FROM documents)"
PAGES = f"docs AS (SELECT page_id AS doc_id, {strip('html')} AS text, html AS raw FROM pages)"
CLEAN_DOCS = f"{DOCS}, cleaned AS (SELECT doc_id, text FROM docs WHERE ({reason('text', 'raw')}) IS NULL)"


def key60(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 15) AS BIGINT)"


def content_hash(*columns: str) -> str:
    return key60(" || ".join(f"coalesce(md5(CAST({c} AS VARCHAR)), '-')" for c in columns))


def schema_rows(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{n}' AS name, '{t}' AS type, '{t}' AS expected_type, 'OK' AS status, count({n}) AS n_values FROM {table}"
        for i, (n, t) in enumerate(columns.items())
    )


def reason_counts(judged: str) -> str:
    tests = {"html": "r = 'html'", "short": "r = 'short'", "empty": "r = 'empty'", "dropped": "r IS NOT NULL", "kept": "r IS NULL"}
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER ({t}) AS docs, {pct(f'count(*) FILTER ({t})', 'count(*)')} AS pct FROM {judged}"
        for n, t in tests.items()
    )


def pii_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS category, count(*) FILTER (pii_{c}) AS docs, {pct(f'count(*) FILTER (pii_{c})', 'count(*)')} AS pct FROM flagged"
        for c in [*PII, "any"]
    )


PERCENTILES = """min(tox_score) AS min_score, max(tox_score) AS max_score, {mean} AS mean_score,
    round(quantile_cont(tox_score, 0.5), 9) AS median_score, round(stddev_samp(tox_score), 9) AS std_score,
    round(quantile_cont(tox_score, 0.9), 9) AS p90_score, round(quantile_cont(tox_score, 0.95), 9) AS p95_score"""


def statements() -> dict[str, str]:
    flags = ", ".join(f"pii_{c}" for c in PII)
    stream_sums = ", ".join(f"count(*) FILTER (r IS NULL AND pii_{c}) AS pii_{c}" for c in [*PII, "any"])
    sorted_shingles = f"list_sort({shingle_list('t')})"
    distribution = PERCENTILES.format(mean=MEAN)
    return {
        # sources
        "assign_doc_id": """SELECT md5(coalesce(md5(text), '-') || coalesce(md5(lang), '-') || coalesce(md5(source), '-')) AS doc_key,
            row_number() OVER (PARTITION BY text, lang, source) - 1 AS copy_no, lang, source, n_chars FROM documents""",
        "row_position_id": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents",
        "corpus_fingerprint": f"""SELECT count(*) AS n_rows, CAST(sum({content_hash("doc_id", "text", "lang", "source", "n_chars")}) AS VARCHAR)
            AS fingerprint FROM documents""",
        "ingest_manifest": """WITH files AS (
                SELECT CAST(floor(doc_id / 100) AS BIGINT) AS part, string_agg(text || chr(10), '' ORDER BY doc_id) AS body FROM documents GROUP BY 1)
            SELECT part, CAST(strlen(body) AS BIGINT) AS bytes, round(strlen(body) / CAST(1048576 AS DOUBLE), 2) AS mb, sha256(body) AS sha256 FROM files""",
        "file_hashes": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(strlen(n_name) + 1 AS BIGINT) AS bytes,
            sha256(n_name || chr(10)) AS sha256 FROM nation""",
        "manifest_totals": "SELECT count(*) AS total_rows, 'url,text,text_clean' AS columns FROM pages",
        "schema_report": schema_rows(
            "documents", {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
        ),
        "jsonl_ingest": f"SELECT url, html AS text, {strip('html')} AS text_clean FROM pages",
        "lexicon_table": f"""WITH toks AS (SELECT doc_id, n_chars, {tokens("text")} AS t FROM documents),
            entries AS (SELECT doc_id, n_chars, unnest(t) AS term, unnest(range(len(t))) AS pos FROM toks)
            SELECT term, max_by((n_chars % 10 + 1) / CAST(10 AS DOUBLE), CAST(doc_id AS HUGEINT) * 4294967296 + pos) AS weight
            FROM entries GROUP BY term""",
        # projections
        "html_strip": f"SELECT page_id, {strip('html')} AS text_clean FROM pages",
        "ingest_select": f"SELECT url, html AS text, {strip('html')} AS text_clean FROM pages",
        "html_ratio": f"SELECT page_id, {ratio('html')} AS html_ratio FROM pages",
        "text_length": "SELECT doc_id, CAST(length(text) AS BIGINT) AS text_length FROM documents",
        "blank_text": f"SELECT doc_id, {blank('text')} AS is_blank FROM documents",
        "shingle_normalize": f"SELECT doc_id, {normalize('text')} AS normalized FROM documents",
        "shingles": f"""WITH norm AS (SELECT doc_id, {normalize("text")} AS t FROM documents),
            sets AS (SELECT doc_id, {sorted_shingles} AS s FROM norm)
            SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, md5(array_to_string(s, '|')) AS shingles_md5 FROM sets""",
        "tox_tokens": f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
            FROM (SELECT doc_id, {tokens("text")} AS t FROM documents)""",
        "toxicity_score": f"WITH {scored('documents')} SELECT doc_id, tox_millis, n_tokens, tox_score FROM scored",
        "toxicity_score_join": f"WITH {scored('documents')} SELECT doc_id, tox_millis, n_tokens, tox_score FROM scored",
        "pii_flags": f"WITH {flagged('documents')} SELECT doc_id, {flags} FROM flagged",
        "pii_any": f"WITH {flagged('documents')} SELECT doc_id, pii_any FROM flagged",
        "text_snippet": """SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS snippet
            FROM documents""",
        "report_values": f"""WITH {CLEAN_DOCS}, {stats("cleaned")} SELECT *, printf('%.2f%%', round_even(pct_pii, 2)) AS pct_pii_text,
            printf('%.2f%%', round_even(pct_toxic, 2)) AS pct_toxic_text, printf('%.4f', round_even(mean_score, 4)) AS mean_score_text FROM stats""",
        # filters
        "quality_reject_reason": f"SELECT page_id, {reason('c', 'html')} AS reject_reason FROM (SELECT page_id, html, {strip('html')} AS c FROM pages)",
        "quality_filter": f"SELECT doc_id, text FROM documents WHERE ({reason('text', 'text')}) IS NULL",
        "quality_report": f"""WITH j AS (SELECT {reason("c", "html")} AS r FROM (SELECT html, {strip("html")} AS c FROM pages))
            {reason_counts("j")}""",
        "quality_report_documents": f"WITH j AS (SELECT {reason('text', 'text')} AS r FROM documents) {reason_counts('j')}",
        "toxicity_flagged": f"WITH {scored('documents')} SELECT doc_id, tox_score FROM scored WHERE tox_score > 0.05",
        # near-duplicates
        "minhash_signature": f"""WITH {signatures("documents")}
            SELECT doc_id, string_agg(m, ',' ORDER BY k) AS signature FROM sig GROUP BY doc_id""",
        "lsh_bands": f"WITH {bands('documents')} SELECT doc_id, CAST(band AS INTEGER) AS band, band_key FROM bands",
        "near_dup_candidates": f"WITH {candidates('documents')} SELECT doc_a, doc_b FROM cand",
        "near_dup_pairs": f"WITH {pairs('documents')} SELECT doc_a, doc_b, jaccard FROM pairs",
        "near_dup_pairs_exact": f"""WITH {candidates("documents")},
            sets AS (SELECT doc_id, {shingle_list("t")} AS s FROM norm
                     WHERE doc_id IN (SELECT doc_a FROM cand UNION SELECT doc_b FROM cand)),
            met AS (SELECT doc_a, doc_b, len(list_intersect(a.s, b.s)) AS common, len(a.s) AS na, len(b.s) AS nb
                     FROM cand JOIN sets a ON a.doc_id = doc_a JOIN sets b ON b.doc_id = doc_b)
            SELECT doc_a, doc_b, common / CAST(na + nb - common AS DOUBLE) AS jaccard FROM met
            WHERE common / CAST(na + nb - common AS DOUBLE) >= 0.8""",
        "near_dup_groups": f"WITH {groups('documents')} SELECT doc_id, rep, copies FROM members",
        "near_dup_similar_groups": f"""WITH {groups("documents")}
            SELECT doc_a AS rep_a, doc_b AS rep_b, matches, a.copies AS copies_a, b.copies AS copies_b FROM agree
            JOIN members a ON a.doc_id = doc_a AND a.rep = doc_a JOIN members b ON b.doc_id = doc_b AND b.rep = doc_b WHERE matches >= 103""",
        "near_dup_summary": f"""WITH {dup_summary("documents")} SELECT 5 AS n, 128 AS num_perm, CAST(0.8 AS DOUBLE) AS threshold,
            16 AS bands, 8 AS rows_per_band, total_docs, total_pairs, round_even({pct("total_pairs", "total_docs")}, 2) AS pair_pct, dup_docs,
            round_even({pct("dup_docs", "total_docs")}, 2) AS dup_doc_pct FROM dups""",
        "near_dup_examples": f"WITH {pairs('documents')} SELECT doc_a, doc_b, jaccard FROM pairs ORDER BY doc_a, doc_b LIMIT 5",
        # aggregates
        "toxicity_distribution": f"WITH {scored('documents')} SELECT {distribution} FROM scored",
        "toxicity_rate": f"""WITH {scored("documents")} SELECT count(*) AS total_docs, count(*) FILTER (tox_score > 0.5) AS toxic_docs,
            {MEAN} AS mean_score, {pct("count(*) FILTER (tox_score > 0.5)", "count(*)")} AS pct_toxic FROM scored""",
        "toxicity_long_list": f"""WITH {scored("documents", f"""told AS (SELECT doc_id, n_chars, {tokens("text")} AS t FROM documents),
            entries AS (SELECT doc_id, n_chars, unnest(t) AS term, unnest(range(len(t))) AS pos FROM told),
            lexicon AS (SELECT term, max_by(n_chars % 10 + 1, CAST(doc_id AS HUGEINT) * 4294967296 + pos) * 100 AS w FROM entries GROUP BY term)""")}
            SELECT doc_id, tox_millis, n_tokens, tox_score FROM scored""",
        "toxicity_top5": f"""WITH {scored("documents")} SELECT doc_id, tox_millis, n_tokens, tox_score,
            CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS snippet
            FROM scored JOIN documents USING (doc_id) ORDER BY tox_score DESC, doc_id LIMIT 5""",
        "pii_report": f"WITH {flagged('documents')} {pii_counts()}",
        "pii_fp_estimate": f"""WITH {flagged("documents")}, counts AS ({pii_counts()}),
            rates(category, fp_rate, fp_note) AS (VALUES {", ".join(f"('{c}', CAST({r} AS DOUBLE), '{n}')" for c, (r, n) in FALSE_HITS.items())})
            SELECT category, docs, fp_rate, fp_note, round(docs * (1 - fp_rate), 2) AS expected_true FROM counts JOIN rates USING (category)""",
        "dataset_stats": f"WITH {CLEAN_DOCS}, {stats('cleaned')} SELECT * FROM stats",
        "clean_rate": f"""WITH {CLEAN_DOCS}, n AS (SELECT (SELECT count(*) FROM docs) AS o, (SELECT count(*) FROM cleaned) AS f)
            SELECT o AS total_original, f AS total_final, {pct("f", "o")} AS pct_clean FROM n""",
        "scorecard_metrics": f"WITH {DOCS}, {scorecard('docs')} SELECT {METRIC_COLUMNS} FROM judged",
        "recommendations": f"WITH {DOCS}, {scorecard('docs')} SELECT metric, value, threshold, status, code, message FROM judged",
        "corpus_audit": f"WITH {PAGES}, {scorecard('docs')} SELECT {METRIC_COLUMNS}, status, code, message FROM judged",
        "audit_files": f"WITH {PAGES}, {scorecard('docs')} SELECT {METRIC_COLUMNS}, status, code, message FROM judged",
        "latest_scorecard": f"""WITH {PAGES}, {scorecard("docs")} SELECT 'SC-20260102-000000' AS run_id, metric, value, score_mean, threshold,
            n_hits, n_total, status FROM judged""",
        # streams
        "stream_ingest": f"SELECT url, html AS text, {strip('html')} AS text_clean FROM pages",
        "stream_batches": f"SELECT url, html AS text, {strip('html')} AS text_clean FROM pages",
        "stream_quantiles": f"""SELECT p, count(*) AS n, true AS in_error
            FROM (SELECT {reason("text", "text")} AS r FROM documents), (SELECT unnest([0.5::DOUBLE, 0.9, 0.95]) AS p) WHERE r IS NULL GROUP BY p""",
        "stream_flags": f"""WITH {scored("documents")}, {flagged("documents")},
            judged AS (SELECT doc_id, {reason("text", "text")} AS r FROM documents)
            SELECT count(*) AS n_rows, count(*) FILTER (r = 'html') AS drop_html, count(*) FILTER (r = 'short') AS drop_short,
                count(*) FILTER (r = 'empty') AS drop_empty, count(*) FILTER (r IS NULL) AS kept, {stream_sums},
                count(*) FILTER (r IS NULL AND tox_score > 0.5) AS toxic
            FROM judged JOIN flagged USING (doc_id) JOIN scored USING (doc_id)""",
    }
