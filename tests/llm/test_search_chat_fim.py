"""Ranked search, chat formatting and fill-in-middle against brute force, and on the defined edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textassay.llm import chat_template as C
from textassay.llm import fill_in_middle, lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [
    None, "", " \n\t", "a", "É é ÀB ab Ab 漢字漢 x\x7fy", "one two  three\n\nfour ", "has <P> mark", "<S", "S> <", " <M>", "x" * 3000, "  nbsp em", "a_b-c'd e@f",
    "  lead and trail \x0b\x0c\r ", "🎉 🎉🎉 z",
]
DOCS = "doc_id long, text string, n string, form int, output double, term string, shard int, item int"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def words(rng, vocabulary, n):
    return " ".join(vocabulary[min(int(rng.expovariate(0.08)), len(vocabulary) - 1)] for _ in range(n))


# --- search ------------------------------------------------------------------------------------


def ranked_by_brute_force(docs, items, top=50):
    counts = [Counter(TERM.findall(lowered(t))) for _, t in docs]
    n = sum(1 for c in counts if c)
    total = sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERM.findall(lowered(text)))
    rows = []
    for item, terms in asked.items():
        scored = []
        for (doc_id, _), c in zip(docs, counts, strict=True):
            if c:
                m = 50 + 50 * c.total() * n // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
                if score > 0:
                    scored.append((-score, doc_id is None, doc_id))
        rows += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(rows, key=repr)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünder", "ÉTÉ", "été"]
    docs = [(i, words(rng, vocabulary, rng.randint(1, 120))) for i in range(2500)]
    docs += [(3000 + i, t) for i, t in enumerate(ODD)] + [(None, words(rng, vocabulary, 30)), (None, "w1 w2"), (7, "w1 w2"), (7, "w1 w2"), (9, "w1 " * 50_000)]
    items = [(i, words(rng, vocabulary, 12).upper()) for i in range(40)] + [(100, None), (101, "!!"), (102, "nothing knows this"), (103, "w1"), (103, "w2 w399"), (None, "w5 w6")]
    return docs, items


@pytest.mark.parametrize("shard_docs", [lexical_search.SHARD_DOCS, 300])
def test_search_matches_brute_force(spark, shard_docs):
    docs, items = corpus()
    table = spark.createDataFrame([(i, t, "x", 1, 1.0, "t", 2, 3) for i, t in docs], DOCS).repartition(2)
    asked = spark.createDataFrame(items, "item_id long, text string")
    if shard_docs == lexical_search.SHARD_DOCS:
        found = lexical_search.rank_documents(table, asked)
    else:  # many shards, and a smaller top
        terms = asked.select(F.col("item_id").alias("item"), F.explode(lexical_search.terms_of("text")).alias("term"))
        terms = terms.groupBy("item").agg(F.collect_set("term").alias("terms"))
        found = lexical_search.search(lexical_search.build_index(table, shard_docs=shard_docs, shard_terms=5_000), terms, 7)
    expected = ranked_by_brute_force(docs, items, 50 if shard_docs == lexical_search.SHARD_DOCS else 7)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


def test_search_in_blocks_of_queries(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(lexical_search, "QUERY_BLOCK", 5)
    monkeypatch.setattr(lexical_search, "BROADCAST_TERMS", 0)
    found = lexical_search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked_by_brute_force(docs, items)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (spark.createDataFrame([(1, None)], docs.schema), items)):
        assert lexical_search.rank_documents(d, i).collect() == []


def test_rejected_blocks_stay_compressed():
    """A rare strong term decides: blocks of the frequent weak list without it are never decompressed."""
    n, blocks = 8 * lexical_search.BLOCK_DOCS, 8
    shard = lexical_search._Shard()
    for i in range(n):
        shard.add(i, "weak strong" if i < 60 else "weak")
    norms = 50 + 50 * np.array(shard.sizes, np.int64)
    lists = []
    frame = shard.batch(1).to_pandas()
    for row in frame[frame["term"].notna()].itertuples():
        row = lexical_search.pd.Series(row._asdict() | {"w": 5000 if row.term == "strong" else 3, "top_m": 50 + 50 * np.asarray(row.top_n, np.int64)})
        lists.append(lexical_search._List(row, norms, blocks))
    docs, scores = lexical_search.search_shard(lists, np.arange(n), blocks, 50)
    assert docs.tolist() == list(range(50)) and len(set(scores.tolist())) == 1
    weak = next(x for x in lists if x.weight == 3)
    assert set(weak.known) <= {0}


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31 - 1, 2**40, 5])
    data, starts = lexical_search.pack(values)
    assert lexical_search.unpack(data).tolist() == values.tolist() and starts[2] == 2
    assert lexical_search.pack(np.zeros(0, int))[0].size == 0


# --- templates ---------------------------------------------------------------------------------


def test_template_language():
    template = C.Template("{# n #}A{% for m in messages %}{% if m.role == 'a' and not (m['text'] == \"\") %}<{{ m.text | trim | upper ~ '!' }}>{% elif 'b' in m.role or false %}b{% else %}{{ 1 }}{% endif %}{% endfor %}{{ x ~ 'Z' }}",
                          {"x": "Y"}, ())
    assert template.render([{"role": "a", "text": " q "}, {"role": "bb", "text": ""}, {"role": "a", "text": ""}]).text == "A<Q!>b1YZ"


def test_constants_are_folded():
    tree = C.Template("a{{ bos ~ '[' }}b{% if 1 == 2 %}no{% elif bos == '<s>' %}yes{% else %}no{% endif %}c").tree
    assert tree == [C.Text("a<s>[byesc")]
    body = C.Template().tree[0].body[0]
    assert isinstance(body, C.Branch) and body.arms[0][1][0] == C.Text("<s>[INST] ")


@pytest.mark.parametrize("source", [
    "{{ message }}", "{{ bos.x }}", "{% for m in bos %}{% endfor %}", "{% for m in messages %}", "{% endif %}", "{% if true %}", "{{ bos | open }}", "{{ bos() }}", "{{ 1 2 }}",
    "{{ __import__ }}", "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}",
    "{% import os %}", "{{ }}", "{{ bos[0] }}", "{% for m in messages %}{{ m.text }}{% endif %}", "{{ none }}",
])
def test_faulty_templates_fail_when_compiled(source):
    with pytest.raises(C.TemplateError):
        C.Template(source)


def test_sandbox_reaches_no_attributes():
    for source in ("{{ m.__class__ }}", "{{ m.text.__class__ }}", "{{ m['keys'] }}", "{{ m }}"):
        with pytest.raises(C.TemplateError):
            C.Template("{% for m in messages %}" + source + "{% endfor %}").render([{"role": "a", "text": "b"}])
    with pytest.raises(C.TemplateError):
        C.Template("x{% for m in messages %}{% endfor %}").turn()


def test_escapes_are_reversible():
    escape, parts = C.escaper(C.CONTROLS), [*C.CONTROLS, "\\", "<", "s>", "[", "/", "INST]", "x"]
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        out = escape(text)
        assert C.unescape(out) == text and not any(c in out for c in C.CONTROLS)
    assert "ab" not in C.escaper(("ab", "ba"))("ababa") and "ba" not in C.escaper(("ab", "ba"))("ababa")


def conversations():
    rng = random.Random(8)
    parts = [*C.CONTROLS, "\\", "hello", "\n", "ü", "🎉", " ", "<", "</s", "[INST"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool[ROLE]"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))))
    rows += [(50, 0, "user", None), (51, None, None, "x"), (51, 3, "user", "y"), (51, 3, "user", "y"), (51, 3, "assistant", "b"), (51, 3, "assistant", "a")]
    rows += [(None, 0, "user", "n"), (None, 1, "assistant", "m"), (60, 0, "assistant", "long " * 300_000), (-7, 1, "assistant", "own")]
    rows += [(99, i, "user" if i % 2 == 0 else "assistant", f"{i} [INST] " * 30) for i in range(4000)]
    return rows


def formatted_by_brute_force(rows):
    said = "</s>[INST] ok [/INST]"
    convs = defaultdict(list)
    for conv, turn, role, text in [*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        convs[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    out = []
    for conv, turns in convs.items():
        turns = [(r, t) for _, _, r, _, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = len(C.Template().render([{"role": r, "text": t} for r, t in turns]).text)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), loss)]
        out.append((conv, len(turns), digests[0], len(loss), digests[1], chars))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [C.BLOCK, 5_000])
def test_formatting_is_read_back(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = conversations()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, block int, loss string").repartition(5)
    found = sorted((tuple(r) for r in C.formatting_report(table).collect()), key=repr)
    assert found == formatted_by_brute_force(rows)


def test_a_long_conversation_is_spread(spark):
    """A conversation with all of the rows is formatted by several tasks, equal rows included."""
    rows = [(1, i // 2000, "user", "same text") for i in range(8000)]
    ordered = C.in_turn_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["n"] for r in ordered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 6000
    (row,) = [r for r in C.formatting_report(spark.createDataFrame(rows, ordered.select("conv_id", "turn", "role", "text").schema)).collect() if r["conv_id"] == 1]
    assert row["n_turns"] == 8000 and row["turns_sha256"] == hashlib.sha256(b"user\nsame text\n" * 8000).hexdigest()


def test_formatting_of_an_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r["conv_id"] for r in C.formatting_report(table).collect()] == [-7]
    assert C.format_turns(table).collect() == []


def test_loss_spans_mark_the_answers(spark):
    table = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a</s>\\")], "conv_id long, turn long, role string, text string")
    user, answer = sorted(C.format_turns(table).collect(), key=lambda r: r["turn"])
    assert user["formatted"] == "<s>[INST] q [/INST]" and user["loss"] == []
    (span,) = answer["loss"]
    assert answer["formatted"][span["start"] : span["end"]] == "a<\\/s>\\\\" and answer["formatted"].endswith("</s>")


# --- fill in the middle ------------------------------------------------------------------------


def filled_by_brute_force(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return "plain", len(units), None, None, text
    form = "spm" if h4 % 100 < 80 else "psm"
    return form, len(units), len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def test_fill_in_middle_matches_brute_force(spark):
    texts = [*ODD * 6, "a <P b", "b c d " * 200_000, None]
    rows = [(i, t, "x", 1, 1.0, "t", 2, 3) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "one two three four", "x", 1, 1.0, "t", 2, 3)]
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    done = fill_in_middle.transform(table)
    assert done.columns == ["doc_id", "text", "term", "shard", "item", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = done.withColumn("back", fill_in_middle.restore()).collect()
    assert len(got) == len(rows) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r["form"], r["n"], r["prefix_chars"], r["middle_chars"], r["output"]) == filled_by_brute_force(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    report = fill_in_middle.fill_report(table).collect()
    assert sorted(r["output_sha256"] for r in report) == sorted(hashlib.sha256(r["output"].encode()).hexdigest() for r in got)
    assert fill_in_middle.fill_report(table.limit(0)).collect() == []


def test_units_of_long_texts_do_not_depend_on_pieces():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab \n") for _ in range(rng.randint(0, 80)))
        expected = [m.end() for m in UNIT.finditer(text)]
        for piece in (1, 2, 7, 1 << 18):
            assert fill_in_middle.unit_ends(text, piece).tolist() == expected
    assert len(fill_in_middle.unit_ends("a b " * 2_000_000)) == 4_000_001
