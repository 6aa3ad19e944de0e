"""The training-data operators against brute force, exact round trips and held-out accuracy, and on the defined edge cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from textassay.llm import (
    ann,
    bpe_chunks,
    fingerprints,
    html_extraction,
    language_id,
    quality_classifier,
    repeats,
    secret_scan,
    simhash,
    source_mixing,
)
from textassay.llm.components import connected_components

TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, votes string, score int, h int, words int"
WORDS = "der the of and thing with ander que para est une maison stone river cloud green over under paper light".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + "etaoin"[j] for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 6, n), strict=True)) + "."


LONG = prose(1, 400)
TEXTS = [
    None, "", "   \n ", "a", "A.", LONG, LONG, LONG[:900] + " changed " + LONG[1000:], prose(2, 60) + " " + LONG[300:700],
    'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y', "AKIA" + "Q7" * 9 + " AKIA12", "naïve Ünder 漢字 🎉 " * 30, prose(3, 30), prose(3, 29) + " x",
    "k9Qw2ZxP7vB4nM8rT3yL6hD1 alone", "token=abc api_key=token:abcdefgh", "z" * 700,
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows with clashing extra columns; the last row is there twice, and one row has no id."""
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), "v", 1, 2, 3) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[-1], (None, prose(9, 12), "en", "s1", 5, None, None, None, None)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def removed_by_brute_force(rows):
    seen = {}
    for _, raw in rows:
        for i in range(len(raw) - 199):
            seen[raw[i : i + 200]] = seen.get(raw[i : i + 200], 0) + 1
    expected = []
    for doc_id, raw in rows:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        expected.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, expected))


def test_repeats_match_brute_force(docs, empty):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    assert sorted(map(str, map(tuple, repeats.remove_repeats(docs).collect()))) == removed_by_brute_force(rows)
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_with_a_crowded_phrase_and_no_ids(spark, monkeypatch):
    """One passage in all documents, shorter and longer than the window, next to texts of their own; no ids, or one id."""
    monkeypatch.setattr(repeats, "CROWDED", 16)
    shared, rng = prose(21, 40), np.random.default_rng(22)
    rows = []
    for i in range(400):
        passage = shared[: int(rng.integers(120, len(shared)))] if i % 2 else shared[int(rng.integers(0, 60)) :][:190]
        rows.append((None if i % 3 else 7, f"{prose(1000 + i, 25)} {passage} {prose(5000 + i, 25)}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(str, map(tuple, repeats.remove_repeats(frame).collect())))
    assert got == removed_by_brute_force([(k, t.encode()) for k, t in rows])
    windows = spark.read.parquet(*[str(p) for p in _scratch(spark).glob("repeat-windows-*")])
    assert windows.groupBy("w1", "w2").count().where("count > 1").count() > 50


def _scratch(spark):
    from pathlib import Path

    from textassay.runtime import scratch_dir

    return Path(scratch_dir(spark))


def test_repeats_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 512)
    raw = np.frombuffer((prose(5, 900) + LONG).encode(), np.uint8)
    small, _ = repeats.phrase_hashes(raw)
    starts, counts = repeats.text_segments(raw, small)
    monkeypatch.setattr(repeats, "BLOCK", 1 << 21)
    assert np.array_equal(small, repeats.phrase_hashes(raw)[0])
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, counts, strict=True)])
    whole = np.concatenate([np.arange(a, a + n) for a, n in zip(*repeats.text_segments(raw, small), strict=True)])
    assert np.array_equal(covered, whole)


def test_language(spark, docs, empty):
    rows = {str(r["doc_id"]): r for r in language_id.language_report(docs).collect()}
    assert rows["0"]["lang_pred"] == rows["1"]["lang_pred"] == rows["2"]["lang_pred"] == "und"
    assert all(r["held_out"] == (zlib.crc32(k.encode()) % 3 == 1) for k, r in rows.items() if k != "None")
    assert language_id.language_report(empty).count() == 0
    table = spark.read.parquet(f"{TABLES}/documents.parquet")
    said = language_id.language_report(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in said]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in said)


def test_long_texts_count_alike(monkeypatch):
    text, symbols = LONG * 3, language_id._symbol_table()
    want = language_id.gram_counts(text, symbols)
    monkeypatch.setattr(language_id, "BLOCK", 257)
    got = language_id.gram_counts(text, symbols)
    assert np.array_equal(want[0], got[0]) and np.array_equal(want[1], got[1])


def test_mix(docs, empty):
    rows = source_mixing.taken_report(docs).collect()
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert len(rows) == docs.count()
    taken = {}
    for r in rows:
        key = (r["source_size"], r["target"])
        taken[key] = taken.get(key, 0) + r["taken"]
    assert all(abs(v - target) <= 1 for (_, target), v in taken.items())
    assert rows == source_mixing.taken_report(docs).collect() or sorted(map(str, rows)) == sorted(map(str, source_mixing.taken_report(docs).collect()))
    assert source_mixing.taken_report(empty).count() == 0
    mixed = source_mixing.mix(docs).collect()
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mixed)
    assert words == sum(r["taken"] for r in rows)


def test_targets_are_water_filled(spark):
    sizes = spark.createDataFrame([("0a", 10), ("0b", 1000), ("0c", 5), ("1", 0)], "source_key string, source_size long")
    got = {r["source_key"]: r["target"] for r in source_mixing.source_targets(sizes).collect()}
    assert got["0a"] == 30 and got["0c"] == 15 and got["1"] == 0 and got["0b"] == pytest.approx(970)


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=#>Home</a><li><a href=#>News</a></ul></nav>
<div class="ad">Buy now and save.</div><article><h1>A &amp; B</h1><p><b>First   block of text here.<br><p>Second one&#33;</p></article><footer>&copy; us</footer>"""


def test_html(spark, empty):
    blocks = [text for _, text, _ in html_extraction.leaf_blocks(PAGE)]
    assert blocks == ["Home", "News", "Buy now and save.", "A & B", "First block of text here.", "Second one!", "© us"]
    pages = spark.createDataFrame([(1, "u", None, 1), (2, "u", "", 2), (3, None, "<p", 3)], "page_id long, url string, html string, text int")
    table = spark.read.parquet(f"{TABLES}/pages.parquet").selectExpr("page_id + 10 page_id", "url", "html", "1 text")
    rows = {r["page_id"]: r for r in html_extraction.main_texts(pages.unionByName(table)).collect()}
    assert rows[1]["text"] == rows[2]["text"] == "" and rows[1]["n_chars"] == 0
    right = 0
    for r in table.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        want = [" ".join(html_extraction.entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        right += rows[r["page_id"]]["text"] == "\n".join(b for b in want if b)
        assert rows[r["page_id"]]["n_chars"] == len(rows[r["page_id"]]["text"])
    assert right >= 0.9 * table.count()
    assert html_extraction.main_texts(empty.selectExpr("doc_id page_id", "source url", "text html")).count() == 0


@pytest.mark.parametrize("taught", [True, False])
def test_html_of_other_pages(spark, taught):
    """Deep class lists, adverts in inline elements, comments by other names; also when no page can be taught from."""
    given = [r["html"] for r in spark.read.parquet(f"{TABLES}/pages.parquet").select("html").collect()] if taught else []
    model, s = html_extraction.teach(given), html_extraction.SENTENCES
    deep = "".join(f'<div class="flex w-full px-4 py-2 mx-auto max-w-screen bg-white text-gray rounded shadow lg l{i}">' for i in range(5))
    article, want = f"<article><p>{s[0]} {s[1]}</p>%s<p>{s[2]} {s[3]}</p></article>", f"{s[0]} {s[1]}\n{s[2]} {s[3]}"
    pages = {
        article % "": want,
        article % '<ins class="adsbygoogle">Buy our soap now</ins>': want,
        article % '<span class="advert">Buy our soap now</span>': want,
        article % "" + '<div id="disqus_thread"><p>I liked this one.</p></div>': want,
        article % "" + '<div class="responses"><p>I liked this one.</p></div>': want,
        f"<article>{deep}<p>{s[0]} {s[1]}</p><p>{s[2]} {s[3]}</p>{'</div>' * 5}</article>": want,
        f'<article><p>{s[0]} <span class="hl">marked</span> {s[1]}</p></article>': f"{s[0]} marked {s[1]}",
    }
    assert html_extraction.extract(model, [f"<html><body>{p}</body></html>" for p in pages]) == list(pages.values())


def test_html_scan_is_linear():
    import time

    pages = ["<a " * 350_000, "<" * 1_000_000 + "<!--", "<div>" * 200_000 + "x", "<div>x</p>" * 100_000, "<b><p>x" * 140_000, "<![CDATA[" * 110_000 + ">", "<a '\" " * 160_000 + ">"]
    for page in pages:
        begun = time.monotonic()
        html_extraction.leaf_blocks(page)
        assert time.monotonic() - begun < 10, page[:20]
    assert [t for _, t, _ in html_extraction.leaf_blocks("a <![CDATA[ b > c ]]> d < e <!-- f > --> g")] == ["a d < e g"]


def test_block_gradient_is_right():
    pages = [html_extraction.inputs(html_extraction.leaf_blocks(PAGE)), html_extraction.inputs(html_extraction.leaf_blocks("<p>one<p>two words"))]
    labels = [np.array([0, 0, 0, 1, 1, 1, 0], np.float32), np.array([1, 0], np.float32)]
    model = html_extraction.BlockLabeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        scores = np.concatenate(model.scores(pages)).astype(float)
        wanted = np.concatenate(labels)
        return -(wanted * np.log(scores) + (1 - wanted) * np.log(1 - scores)).mean()

    grad = model._gradients(pages, labels)
    for name in ("wf", "cb", "out"):
        flat, i = model.p[name].reshape(-1), 7
        flat[i] += 1e-3
        up = loss()
        flat[i] -= 2e-3
        slope = (up - loss()) / 2e-3
        flat[i] += 1e-3
        assert slope == pytest.approx(float(grad[name].reshape(-1)[i]), abs=2e-4)


def test_bpe_round_trip(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe_chunks.default_vocabulary())
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe_chunks.encode_texts(docs).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe_chunks.coding_report(docs).count() == docs.count()
    assert bpe_chunks.coding_report(empty).count() == 0


@pytest.mark.parametrize("mean", [3, 17])
def test_chunk_joins_are_repaired(monkeypatch, mean):
    monkeypatch.setattr(bpe_chunks.chunk_ends, "__defaults__", (mean,))
    codec = bpe_chunks.ChunkCodec(bpe_chunks.default_vocabulary())
    rng = np.random.default_rng(3)
    letters = [*"ab éÉİΣς \n\t 'sd1漢🎉\x85ß.,", "<|endoftext|>", "ing", " the "]
    for n in range(120):
        text = "".join(letters[i] for i in rng.integers(0, len(letters), n))
        assert codec.encode(text) == codec.library_ids(text)


def test_words_of_plain_characters_are_made_of_pieces(monkeypatch):
    """Cases and marks of a word ask the model for it once and the library never, and the ids are the library's."""
    codec = bpe_chunks.ChunkCodec(bpe_chunks.default_vocabulary())
    library, made = codec.library_ids, []
    monkeypatch.setattr(codec, "library_ids", lambda text: pytest.fail(f"library asked for {text}"))
    monkeypatch.setattr(codec, "piece_ids", lambda piece, make=codec.piece_ids: made.append(piece) or make(piece))
    text = "  stesth Stesth, stesth%%% STESTH!! (stesth) \"stesth's\" 'stesth' a1stesth22 \x0bÜBER stesth''ll ÿß_über's$$$ \n"
    assert codec.encode(text) == library(text)
    assert made.count("stesth") == 1 and made.count("über") == 1


def test_pieces_are_those_of_the_library():
    codec = bpe_chunks.ChunkCodec(bpe_chunks.default_vocabulary())
    rng = np.random.default_rng(11)
    letters = [*map(chr, range(1, 256)), "'s", "'LL", "'re", "''", " ", " ", "\n", "ab", "É", "<|endoftext|>", "<|", "\u0301", "\u2003", "Σ", "İ"]
    for n in range(400):
        text = "".join(letters[i] for i in rng.integers(0, len(letters), n % 90))
        assert codec.encode(text) == codec.library_ids(text)


@pytest.mark.parametrize("limit", [1, 200, 10**6])
def test_texts_hashed_together_are_cut_as_alone(monkeypatch, limit):
    monkeypatch.setattr(bpe_chunks, "HASHED_BYTES", limit)
    monkeypatch.setattr(bpe_chunks.chunk_ends, "__defaults__", (5,))
    rng = np.random.default_rng(4)
    texts = ["", "é" * 40, "\0" * 30, "a", "", *("".join(map(chr, rng.integers(0, 900, n))) for n in range(60)), ""]
    raws = [text.encode() for text in texts]
    alone = [(raw, bpe_chunks.chunk_ends(np.frombuffer(raw, np.uint8)).tolist()) for raw in raws]
    assert list(bpe_chunks.chunked(texts)) == alone and list(bpe_chunks.chunked([])) == []


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(values):
    """Components of (id, fingerprint) pairs by brute force: id -> smallest id."""
    best = {i: i for i, _ in values}
    changed = True
    while changed:
        changed = False
        for a, x in values:
            for b, y in values:
                if (x ^ y).bit_count() <= 3 and best[a] != best[b]:
                    best[a] = best[b] = min(best[a], best[b])
                    changed = True
    return best


def test_simhash(docs, empty):
    rows = simhash.near_dup_classes(docs).select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id").collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(int(r["fingerprint"], 16) == brute_print(texts[r["doc_id"]]) for r in rows)
    best = components([(r["doc_id"], int(r["fingerprint"], 16)) for r in rows if r["doc_id"] is not None])
    assert all(r["component_id"] == best[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert simhash.near_dup_classes(empty).count() == 0


@pytest.mark.parametrize("crowded", [512, 4])
def test_links_are_complete(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(8)
    values = set()
    for base in rng.integers(-(2**62), 2**62, 12).tolist():
        for _ in range(25):
            flipped = base
            for bit in rng.integers(0, 63, rng.integers(0, 4)).tolist():
                flipped ^= 1 << bit
            values.add(flipped)
    got = {tuple(r) for r in simhash.linked(spark.createDataFrame([(v,) for v in values], "f long")).collect()}
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert got == want


def test_probes_are_never_broadcast(spark):
    # Tables this small are broadcast where Spark may choose; probes are 66 rows a fingerprint, and the choice must not hang on their size.
    joined = simhash.linked(spark.range(40).selectExpr("id * 7919 as f"))
    joined.collect()
    inner = [x for x in joined._jdf.queryExecution().toString().splitlines() if "Join" in x and "Inner" in x and "Join Inner" not in x]
    assert inner and all("SortMergeJoin" in x for x in inner), inner


def test_components_of_a_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[100:300] = x[100]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)] + [(900, None, "x"), (901, [0.0] * 8, "x"), (902, [float("nan")] * 8, "x"), (903, [None] * 8, "x"), (5, x[5].tolist(), "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    from pyspark.sql import functions as F

    out = {}
    for r in ann.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact, hits = x.astype(float), []
    for q, found in out.items():
        scores = (exact * exact[q]).sum(axis=1)
        scores[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -scores))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(scores[v], abs=1e-12) for _, v, s in found)
        hits.append(len({v for _, v, _ in found} & set(want.tolist())) / 20)
    assert sorted(out) == list(range(0, 600, 20)) and np.mean(hits) >= 0.9
    tied = [v for _, v, _ in sorted(out[100]) if 100 < v < 300]
    assert tied and tied == list(range(101, 101 + len(tied)))  # ties go to smaller ids
    assert ann.nearest(frame.where("vec_id > 899 and vec_id < 904"), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.nearest(frame.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert len(few) == 2


def test_fingerprints(docs, empty):
    rows = fingerprints.fingerprint_report(docs).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids = sorted((i for i in texts if i is not None), reverse=True) + [None]
    by_text = {}
    for r in rows:
        text = texts[r["doc_id"]]
        following = texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert by_text[""] == "" and fingerprints.fingerprint_report(empty).count() == 0


def test_likeness_estimates_generalised_jaccard(spark):
    a, b = prose(21, 900), prose(21, 900)[:3000] + prose(22, 500)
    frame = spark.createDataFrame([(0, a, b)], "k long, a string, b string")
    row = fingerprints.signatures(frame, ["k"], ["a", "b"], bins=128).select(fingerprints.likeness(*map(_col, ("a_cells", "b_cells"))).alias("x")).first()

    def bag(text):
        words, out = text.split(), {}
        for p in zip(words, [*words[1:], None], strict=True):
            out[p] = out.get(p, 0) + 1
        return out

    x, y = bag(a), bag(b)
    want = sum(min(x.get(t, 0), y.get(t, 0)) for t in {*x, *y}) / sum(max(x.get(t, 0), y.get(t, 0)) for t in {*x, *y})
    assert row["x"] == pytest.approx(want, abs=0.15)


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def base_spans(text):
    out = []
    for no, (kind, pattern, group, least) in enumerate(secret_scan.KINDS):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                out.append((m.start(), no, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets(docs, empty):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = secret_scan.scan_report(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["base_sha256"] == hashlib.sha256(base_spans(texts[r["doc_id"]]).encode()).hexdigest()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[14]["spans"] == "entropy:0:24" and by_id[15]["n_assign"] == 0 and by_id[5]["spans"] == ""
    assert secret_scan.scan_report(empty).count() == 0
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert clean[9] == 'x [SECRET]" y' and clean[0] is None and clean[5] == texts[5] and clean[14] == "[SECRET] alone"


def all_spans(text):
    """Base spans and entropy spans by plain Python."""
    from math import log2

    base = [(int(x.split(":")[1]), [k for k, *_ in secret_scan.KINDS].index(x.split(":")[0]), int(x.split(":")[2])) for x in base_spans(text).split(",") if x]
    out = list(base)
    for m in re.finditer(secret_scan.CANDIDATE, text):
        part, a, b = m.group(), m.start(), m.end()
        allowed = [r"^[0-9+/_=-]+$", r"^[/+_=-]*[A-Za-z]?[a-z]*([/+_=-]+[A-Za-z]?[a-z]*)*$", r"^[A-Z]+([/+_=-]+[A-Z]*)*$", secret_scan.ALLOWED[3], "(?i)example"]
        if any(re.search(p, part) for p in allowed) or any(x < b and a < y for x, _, y in base):
            continue
        limit = next(v for p, v in secret_scan.LIMITS if re.search(p, part))
        windows = [part[i : i + 20] for i in range(len(part) - 19)]
        if max(-sum(w.count(c) / 20 * log2(w.count(c) / 20) for c in set(w)) for w in windows) >= limit - 1e-9:
            out.append((a, len(secret_scan.KINDS), b))
    kinds = [*[k for k, *_ in secret_scan.KINDS], "entropy"]
    return ",".join(f"{kinds[no]}:{a}:{b}" for a, no, b in sorted(out))


def test_spans_match_plain_python(spark):
    """Random mixtures with more matches than a chunk holds, overlaps of kinds, and matches that are too short."""
    rng = np.random.default_rng(31)
    letters = [*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"]

    def word(n, of=letters):
        return "".join(of[i] for i in rng.integers(0, len(of), n))

    def piece():
        return [
            lambda: word(int(rng.integers(1, 40))), lambda: word(int(rng.integers(20, 60)), [*"0123456789abcdef"]), lambda: "AKIA" + word(int(rng.integers(1, 24)), [*"ABIK0123"]),
            lambda: "token=" + word(int(rng.integers(1, 30))), lambda: "Secret: '" + word(7) + "'", lambda: "naïve 🎉", lambda: "token=token:abcdefgh", lambda: "lower/case/path/words/only",
            lambda: "EXAMPLE" + word(30), lambda: "AAAA" * 8, lambda: "",
        ][int(rng.integers(0, 11))]()

    texts = [" ".join(piece() for _ in range(n)) for n in (1, 3, 30, 300, 3000) for _ in range(4)] + [None, "", "token=a " * 1200]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secret_scan.scan_report(frame).collect():
        assert r["spans"] == all_spans(texts[r["doc_id"]] or ""), r["doc_id"]
    for r in secret_scan.redact(frame).collect():
        text, out, end = texts[r["doc_id"]], "", 0
        for a, b in [map(int, x.split(":")[1:]) for x in all_spans(text or "").split(",") if x]:
            out, end = out + (text[end:a] + "[SECRET]" if a >= end else ""), max(end, b)
        assert r["text"] == (None if text is None else out + text[end:])


def test_secrets_in_very_long_runs(spark):
    """A megabyte of base64 or of hexadecimal words takes seconds: time does not grow with the square."""
    import base64
    import time

    raw = np.random.default_rng(32).bytes(750_000)
    texts = [base64.b64encode(raw).decode(), " ".join(raw[i : i + 13].hex() for i in range(0, 500_000, 13))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begun = time.monotonic()
    rows = {r["doc_id"]: r for r in secret_scan.scan_report(frame).collect()}
    assert time.monotonic() - begun < 60
    assert rows[0]["spans"] == f"entropy:0:{len(texts[0])}" and rows[1]["n_hex"] == len(texts[1].split()) - (len(texts[1].split()[-1]) < 24)


def test_entropy_is_the_largest_of_all_windows(spark):
    from math import log2

    values = ["abcabcabcabcabcabcabcabc", "k9Qw2ZxP7vB4nM8rT3yL6hD1x", "short", "a" * 30]
    got = {r["s"]: r["e"] for r in spark.createDataFrame([(v,) for v in values], "s string").select("s", secret_scan.entropy_peak(_col("s")).alias("e")).collect()}
    for v in values:
        windows = [v[i : i + 20] for i in range(len(v) - 19)]
        want = max((-sum(w.count(c) / 20 * log2(w.count(c) / 20) for c in set(w)) for w in windows), default=0.0)
        assert got[v] == pytest.approx(want, abs=1e-9)


def test_quality(spark, docs, empty):
    assert quality_classifier.score_quality(docs).count() == docs.count()
    assert quality_classifier.score_quality(empty).count() == 0
    table = spark.read.parquet(f"{TABLES}/documents.parquet")
    gold = spark.read.parquet(f"{TABLES}/labels.parquet")
    rows = quality_classifier.score_quality(table).join(gold, "doc_id").collect()
    assert np.mean([r["keep"] == bool(r["quality"]) for r in rows]) > 0.85


def test_em_finds_the_better_labeller():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.8
    rates = [0.95, 0.9, 0.85, 0.6]
    seen = np.array([[int(t) if rng.random() < r else 1 - int(t) for r in rates] for t in truth])
    patterns, counts = np.unique(seen, axis=0, return_counts=True)
    _, tables, good = quality_classifier.fit_votes(patterns, counts.astype(float), trust=0.0)
    right = [tables[i, 1, quality_classifier.GOOD] for i in range(4)]
    assert right[0] > right[3] and good[(patterns == 1).all(axis=1)][0] > 0.9 and good[(patterns == 0).all(axis=1)][0] < 0.1


def test_pipeline(spark, docs):
    frame, names = docs, docs.columns
    kept = corpus_pipeline.keep_known_languages(spark, frame, TABLES)
    assert kept.columns == names and {r["doc_id"] for r in kept.collect()} >= {3, 5, 6, 11} and not {r["doc_id"] for r in kept.collect()} & {0, 1, 2}
    single = corpus_pipeline.drop_near_duplicates(spark, kept, TABLES)
    ids = [r["doc_id"] for r in single.collect()]
    assert 5 in ids and 6 not in ids and ids.count(16) == 1 and single.columns == names
    masked = corpus_pipeline.mask_secrets(spark, single, TABLES)
    assert masked.count() == single.count() and "[SECRET]" in {r["doc_id"]: r["text"] for r in masked.collect()}[9]
    mixed = corpus_pipeline.mix_sources(spark, masked, TABLES)
    assert mixed.columns == names and mixed.count() > 0
    coded = corpus_pipeline.encode_documents(spark, mixed, TABLES)
    assert coded.count() == mixed.count()
    assert corpus_pipeline.run(spark, TABLES).count() > 0


def test_pipeline_loses_no_document_without_copies(spark):
    texts = [prose(100 + i, 120) for i in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (1, texts[1]), (None, texts[2]), (None, texts[2] + " end."), (7, texts[3]), (7, texts[4]), (3, texts[4]), (9, texts[5]), (9, texts[5]), (8, texts[6])]
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    # No language to learn from: only texts without a letter are rejected.
    unlettered = docs.unionByName(docs.limit(1).selectExpr("20L as doc_id", "'12 -- 34' as text", "lang", "source", "n_chars"))
    known = corpus_pipeline.keep_known_languages(spark, unlettered, TABLES).collect()
    assert len(known) == len(rows) and {r["lang"] for r in known} == {"und"}
    assert brute_print(texts[2]) != brute_print(texts[2] + " end.") and bin((brute_print(texts[2]) ^ brute_print(texts[2] + " end.")) & (1 << 64) - 1).count("1") <= 3
    single = corpus_pipeline.drop_near_duplicates(spark, docs, TABLES).collect()
    kept = [(r["doc_id"], texts.index(r["text"].removesuffix(" end."))) for r in single]
    assert sorted(kept, key=str) == sorted([(None, 0), (1, 1), (None, 2), (7, 3), (3, 4), (9, 5), (8, 6)], key=str)


def test_pipeline_predicts_each_text_once(spark, docs):
    # A filter on the prediction must not bring a second run of it, with Python workers of its own.
    kept = corpus_pipeline.keep_known_languages(spark, docs, TABLES)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pipeline_broadcasts_no_probes(spark, docs, monkeypatch):
    met = []
    monkeypatch.setattr(simhash, "connected_components", lambda links: met.append(links) or connected_components(links))
    corpus_pipeline.drop_near_duplicates(spark, docs, TABLES)
    inner = [x for x in met[0]._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "Inner" in x]
    assert len(met) == 1 and inner and all("SortMergeJoin" in x for x in inner), inner


def test_neighbours_of_outliers_are_as_many(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    far = np.zeros((13, 8))
    far[:12, 0], far[12, 1] = 40, -60  # a tight group of 12 far off, and one vector alone
    x = np.concatenate([rng.normal(size=(4000, 8)), far + rng.normal(size=(13, 8)) * 0.01]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    counts = ann.nearest(frame, (F.col("vec_id") % 500 == 0) | (F.col("vec_id") >= 4000)).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in counts} == dict.fromkeys([*range(0, 4000, 500), *range(4000, 4013)], 20)
    # A query on a centroid looks as far as others do.
    graph = ann.CentroidGraph(np.array([[0.0, 0], [1, 0], [0, 1], [9, 9]], np.float32), typical=1.0)
    assert sorted(graph.probes(np.zeros(2, np.float32), np.full(4, 50), 21)) == [0, 1, 2]
    assert sorted(graph.probes(np.zeros(2, np.float32), np.array([5, 5, 5, 50]), 21)) == [0, 1, 2, 3]


@pytest.mark.parametrize("pieces", [20_000, 7])
def test_a_hot_vector_meets_itself_once(spark, monkeypatch, pieces):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ann, "UNIT_QUERIES", pieces, raising=False)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(900, 6)).astype(np.float32)
    x[rng.permutation(900)[:600]] = x[0]
    x[5:9] = x[4]
    x[4:7, 2], x[7:9, 2] = 0.0, -0.0
    assert ann.distinct_vectors(ann.vectors_of(frame := spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")), 21).count() == len(np.unique(x + 0.0, axis=0))
    largest = ann.distinct_vectors(ann.vectors_of(frame), 21).select(F.max(F.size("ids"))).first()[0]
    assert largest == 21
    found = {}
    for r in ann.nearest(frame, F.col("vec_id") % 10 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact = x.astype(float)
    assert sorted(found) == list(range(0, 900, 10))
    for q, rows in found.items():
        scores = (exact * exact[q]).sum(axis=1)
        scores[q] = -np.inf
        rows.sort()
        # There is one list only, so nothing is missed, and ties go to smaller ids.
        assert [(v, pytest.approx(scores[v], abs=1e-12)) for v in np.lexsort((np.arange(900), -scores.round(9)))[:20].tolist()] == [(v, s) for _, v, s in rows]
        assert [n for n, _, _ in rows] == list(range(1, 21))


@pytest.mark.parametrize(("first", "size"), [(0x0430, 32), (0x03B1, 25)])
def test_languages_of_other_alphabets(spark, first, size):
    """Two invented languages that share one alphabet beyond a-z are told apart, from short texts."""
    rng = np.random.default_rng(first)
    letters = [chr(first + i) for i in range(size) if chr(first + i).isalpha()]
    rows = []
    for lang in ("one", "two"):
        parts = ["".join(rng.choice(letters, rng.integers(2, 4))) for _ in range(40)]
        for i in range(200):
            text = " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(8))
            rows.append((len(rows), text, lang if i % 2 else None, lang))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string").repartition(2)
    said = language_id.identify(table, table).where("lang is null").collect()
    assert sum(r["lang_pred"] == r["truth"] for r in said) >= 0.9 * len(said)
    assert len(set(language_id._symbol_table()[[ord(c) for c in letters]])) > 12


def test_packed_fingerprints(spark):
    rng = np.random.default_rng(4)
    rows = [([],)] + [(sorted(int(b) * 65536 + int(rng.integers(0, 65536)) for b in rng.choice(128, n, replace=False)),) for n in (1, 2, 60, 128, 128)]
    rows += [([0],), ([127 * 65536 + 65535],), ([63 * 65536, 64 * 65536 + 0x8000],)]
    table = spark.createDataFrame(rows, "cells array<int>")
    for r in table.select("cells", fingerprints.unpacked(fingerprints.packed(fingerprints.F.col("cells"))).alias("back")).collect():
        assert r["back"] == r["cells"]


def test_shared_start_is_sampled_like_two_whole_texts(spark):
    """Cuts inside words, at blanks and in texts without a whole word give the terms of the two texts."""
    starts = ["", "a", "abc", "   ", " a b c ", "a  b\n\nc d e f  ", "\t q", "ab cd ef gh ij kl mn " * 4, "é è ü  日本 語 x", "word" * 30, "x y x y x y x y "]
    rows = []
    for k, text in enumerate(starts):
        for nth, other in enumerate(["", " ", "zz yy xx ww vv uu tt", "  lead and trail  ", "ab"]):
            third = len(text) // 3
            rows.append((k, nth, text, text[: len(text) - third] + other[:third]))
    frame = spark.createDataFrame(rows, "k long, nth int, text string, edited string").repartition(3, "k")
    whole = fingerprints.signatures(frame, ["k", "nth"], ["text", "edited"]).collect()
    shared = fingerprints.edited_signatures(frame).collect()
    assert sorted(shared) == sorted(whole) and len(whole) > 30


def test_word_memo_keeps_the_newer_half(monkeypatch):
    """However many words pass by, the memo is bounded, and a word in use is not made again."""
    from textassay.llm import bpe_chunks

    monkeypatch.setattr(bpe_chunks, "MEMO_WORDS", 100)
    made = []
    memo = bpe_chunks._Memo(lambda word: made.append(word) or word.encode())
    for i in range(1_000):
        assert memo[f"w{i}"] == f"w{i}".encode() and memo["common"] == b"common"
        assert len(memo) + len(memo.older) <= 101
    assert made.count("common") == 1 and memo[""] == b""


def test_phrases_are_counted_by_48_bits():
    from textassay.llm import repeats

    _, _, h = repeats.Block(np.random.default_rng(1).integers(0, 256, 50_000).astype(np.uint8)).phrases()
    assert len(h) > 1_000 and h.min() >= 0 and h.max() < 2**48 and len(np.unique(h)) == len(h)
