"""SQL of a second engine for the queries of this package that SQL can express."""

OP3 = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents),
sources AS (
  SELECT sk, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY sk) - 1 AS n FROM sized GROUP BY sk),
weighed AS (
  SELECT sk, source_size, CAST([5, 2, 1][n % 3 + 1] AS HUGEINT) AS w, CAST(source_size AS HUGEINT) * 3 AS cap FROM sources),
left_over AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_rest
  FROM weighed
  WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, cap * w_rest <= rest * w AS capped FROM left_over),
targets AS (
  SELECT sk, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(max(rest) FILTER (WHERE NOT capped) OVER () AS DOUBLE) * CAST(w AS DOUBLE)
                   / CAST(max(w_rest) FILTER (WHERE NOT capped) OVER () AS DOUBLE) END AS target
  FROM marked),
queued AS (
  SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY sk ORDER BY turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized JOIN targets USING (sk))
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, budget - ahead)) + greatest(0, least(size, budget - ahead - source_size))
            + greatest(0, least(size, budget - ahead - 2 * source_size)) AS BIGINT) AS taken
FROM queued
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_TERMS} AS terms FROM documents),
counted AS (SELECT row_no, doc_id, unnest(terms) AS term FROM docs),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tfs AS (SELECT row_no, term, count(*) AS tf FROM counted WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term),
norms AS (
  SELECT row_no, doc_id, 50 + (50 * CAST(len(terms) AS BIGINT) * n_docs) // n_terms AS m FROM docs, totals WHERE len(terms) > 0),
scored AS (
  SELECT item_id, row_no, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN norms USING (row_no) GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN norms USING (row_no) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _escaped_length(text: str) -> str:
    """Code points of a text whose backslashes and control strings have one more each."""
    controls = ("\\", "<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
    found = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in controls]
    return " + ".join([f"length({text})", *found])


OP12 = f"""
WITH spoken AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, {_escaped_length("text")} + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 4 ELSE 20 + {_escaped_length("role")} END AS chars FROM spoken)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP13 = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM hashed),
placed AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def statements() -> dict[str, str]:
    return {"op3_source_mixing": OP3, "op11_lexical_search": OP11, "op12_chat_formatting": OP12, "op13_fill_in_middle": OP13}
