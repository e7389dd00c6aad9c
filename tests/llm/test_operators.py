"""Operators against brute force, the public libraries and exact round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import (components, html_extract, huffman, jaccard_join, line_dedup, packing, piece_dropout, quality_rules,
                            queries, syncmers, token_counts, toxicity)
from tallyspark.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE, tokenizer_path
from tallyspark.llm.tokens import WordEncoder
from tallyspark.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    import duckdb

    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') AS text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


# ---- 1 quality rules -----------------------------------------------------------
def _repeat_words(words):
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})


def test_repeat_words_equals_brute_force(spark):
    rng = random.Random(3)
    samples = [" ".join(rng.choice("ab cd ef gh".split() if n % 2 else "a b c d e f g h i".split()) for _ in range(n)) for n in range(40)]
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    got = {r.text: r.n for r in df.select("text", quality_rules.measures(F.col("text"))["n_repeat_words"].alias("n")).collect()}
    assert all(got[s] == _repeat_words(s.split()) for s in samples)


def test_small_hosts_are_shrunk_and_clean_documents_stay(spark):
    good, noisy = "some plain words of text that differ " * 1, "x # y"
    clean = " ".join(f"w{i}" for i in range(60))
    slightly = clean + " " + "# " * 8            # over the strict limit only
    rows = [(i, noisy, "bad") for i in range(40)] + [(100 + i, clean, f"h{i % 5}") for i in range(100)]
    rows += [(300, clean, "bad"), (301, slightly, "bad"), (302, slightly, "h1"), (303, good, "tiny")]
    out = {r.doc_id: r for r in quality_rules.score_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[300].kept and not out[301].kept and out[302].kept
    assert out[303].host_rate < 0.9              # one failure of one: drawn towards the prior


# ---- 2 line dedup ---------------------------------------------------------------
def test_runs_of_short_lines_are_found_wherever_they_start(spark):
    rng = random.Random(1)
    line = lambda: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(999)) for _ in range(rng.randint(1, 12)))
    run = [line() for _ in range(25)]
    docs = [(0, "\n".join([line() for _ in range(5)] + run + [line() for _ in range(5)]))]
    for i in range(1, 9):
        docs.append((i, "\n".join([line() for _ in range(rng.randint(0, 9))] + run + [line() for _ in range(rng.randint(0, 9))])))
    docs.append((9, "\n".join(run[:2])))         # under 50 words: stays
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[0].removed == [] and out[9].removed == []
    for i in range(1, 9):
        lines = docs[i][1].split("\n")
        assert out[i].clean_text == "\n".join(x for x in lines if x not in run)


def _later_copies(docs, min_words=50):
    """Brute force: the lines of every window that stands earlier, over all windows by start and by end."""
    seen, gone = {}, {i: set() for i, _ in docs}
    for i, text in docs:
        lines = [(k, tuple(x.split())) for k, x in enumerate(text.split("\n")) if x.split()]
        size = [len(x) for _, x in lines]
        for a in range(len(lines)):
            for z in range(a + 1, len(lines) + 1):
                n = sum(size[a:z])
                if n >= min_words and (n - size[a] < min_words or n - size[z - 1] < min_words):
                    first = seen.setdefault(tuple(x for _, x in lines[a:z]), (i, a))
                    if first != (i, a):
                        gone[i].update(range(lines[a][0], lines[z - 1][0] + 1))
    return gone


def test_a_run_goes_even_if_its_longest_line_first_occurs_elsewhere(spark):
    line = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    c, x, p = line("c", 30), line("x", 25), line("p", 25)
    tail, last = line("t", 4), line("y", 4)
    docs = [(0, f"{c}\n{x}"), (1, f"{c}\n{p}"), (2, f"{c}\n{p}"), (3, f"own words\n{c}\n\n{p}\nmore own words"),
            (4, f"{c}\n{p}\n{tail}"), (5, f"{c}\n{p}\n{last}"), (6, f"{c}\n{p}\n{tail}")]
    rng = random.Random(4)
    pool = [line(f"l{k}x", rng.randint(1, 30)) for k in range(12)]
    docs += [(10 + k, "\n".join(rng.choice([*pool, ""]) for _ in range(rng.randint(3, 25)))) for k in range(60)]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [out[i].clean_text for i in range(7)] == [docs[0][1], docs[1][1], "", "own words\nmore own words", tail, last, ""]
    want = _later_copies(docs)
    assert all(set(out[i].removed) == want[i] and len(out[i].removed) == len(want[i]) for i, _ in docs)


# ---- 3 toxicity -------------------------------------------------------------------
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    found = got[(got.toxic == 1)].predicted.mean()
    wrong = got[(got.toxic == 0)].predicted.mean()
    # about one toxic label in seven marks a text whose words were replaced by junk
    assert len(got) > 500 and found > 0.8 and wrong < 0.01


# ---- 4 pieces ----------------------------------------------------------------------
def test_pieces_follow_the_library_and_decode_losslessly(texts, monkeypatch):
    import sentencepiece

    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        model = f.read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    samples = [t for _, t in texts] + ["", " ", "  a  b ", "\n\n x\ty\r", "中文 é🎉 <s> <0x41> \x00z", "a" * 300]
    keys = np.arange(len(samples), dtype=np.uint64)
    offsets, ids = piece_dropout.PieceCodec(model, dropout=0.0, variants=1).encode(samples, keys)
    assert all(ids[a:b].tolist() == library.encode(s) for s, a, b in zip(samples, offsets, offsets[1:]))
    samples += ["▁ literal ▁mark"]
    keys = np.arange(len(samples), dtype=np.uint64)
    codec = piece_dropout.PieceCodec(model, seed=5, dropout=0.2)
    offsets, varied = codec.encode(samples, keys)
    assert all(codec.decode(varied[a:b]) == s for s, a, b in zip(samples, offsets, offsets[1:]))
    assert len(varied) > len(ids)                                             # skipped merges leave shorter pieces
    again = piece_dropout.PieceCodec(model, seed=5, dropout=0.2).encode(samples[::-1], keys[::-1])[1]
    assert sorted(again) == sorted(varied)                                     # order and worker play no part
    other = piece_dropout.PieceCodec(model, seed=6, dropout=0.2).encode(samples, keys)[1]
    assert len(other) != len(varied) or (other != varied).any()
    rng = random.Random(0)
    words = ["".join(rng.choice("▁abcdeontih") for _ in range(rng.randint(1, 90))) for _ in range(500)]
    many = codec.segments(words, [1] * len(words))
    monkeypatch.setattr(piece_dropout, "SHORT", 0)             # the heap, one word at a time
    assert codec.segments(words, [1] * len(words)) == many


def test_every_occurrence_draws_its_own_skips(spark):
    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        model = f.read()
    codec = piece_dropout.PieceCodec(model, seed=3, dropout=0.1)
    word, n = "\u2581understanding", 3000
    keys = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    many = codec.segments([word] * n, keys)
    unskipped = codec._settle([word], np.zeros(n, dtype=np.int64), keys) == codec.nodes[word]
    spans = np.frombuffer(codec.node_spans[codec.nodes[word]], dtype=np.uint64)
    assert len(set(many)) > 10                                     # more than a few cached ways
    assert abs(unskipped.mean() - 0.9 ** len(spans)) < 0.03   # every candidate skipped at the dropout rate
    fresh = [piece_dropout.PieceCodec(model, seed=3, dropout=0.1).segments([word], [k])[0] for k in keys[:8]]
    assert fresh == many[:8]                                       # the cache plays no part
    docs = spark.createDataFrame([(i, "understanding " * 40) for i in range(50)], "doc_id long, text string")
    rows = piece_dropout.encode(docs, tokenizer_path(PIECE_BPE), seed=17).collect()
    assert len({bytes(r.ids) for r in rows}) == 50


def _plain_agenda(codec, word, key):
    """One candidate after the other over a list of pieces; skipped by the codec's hash of its span."""
    salt = np.array([xxhash.xxh64_intdigest(word, codec.seed)], dtype=np.uint64) + np.array([key]) * np.uint64(0xC2B2AE3D27D4EB4F)
    pieces, passed = [(i, i + 1) for i in range(len(word))], set()
    while True:
        offers = [(codec.rank[word[a:c]], a, b, c) for (a, b), (_, c) in zip(pieces, pieces[1:])
                  if word[a:c] in codec.rank and (a, b, c) not in passed]
        if not offers:
            return [i for a, b in pieces for i in ([codec.ids[word[a:b]]] if word[a:b] in codec.ids
                                                   else [codec.byte_ids[x] for x in word[a:b].encode()])]
        _, a, b, c = min(offers)
        if codec._skipped(salt, codec._span(*np.array([[a], [b], [c]], dtype=np.uint64)))[0]:
            passed.add((a, b, c))
        else:
            at = pieces.index((a, b))
            pieces[at:at + 2] = [(a, c)]


@pytest.mark.parametrize("cache_bytes", [40_000_000, 100_000, 0])
def test_skips_equal_a_plain_agenda_whatever_the_cache_holds(texts, monkeypatch, cache_bytes):
    monkeypatch.setattr(piece_dropout, "CACHE_BYTES", cache_bytes)
    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        codec = piece_dropout.PieceCodec(f.read(), seed=11, dropout=0.15)
    rng = random.Random(4)
    words = [piece_dropout.SPACE + w for w in " ".join(t for _, t in texts[:20]).split()[:600]] + ["\u2581\u00e9\u4e2d" * 30, "a" * 200]
    for _ in range(3):
        keys = np.array([rng.getrandbits(64) for _ in words], dtype=np.uint64)
        got = [np.frombuffer(x, np.uint32).tolist() for x in codec.segments(words, keys)]
        assert got == [_plain_agenda(codec, w, k) for w, k in zip(words, keys)]


def test_an_occurrence_is_merged_once_however_much_it_skips(monkeypatch):
    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        codec = piece_dropout.PieceCodec(f.read(), seed=3, dropout=0.3)
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("\u2581abcdeontih") for _ in range(24)) for _ in range(300)})
    merged, merge = [], codec._merge_many
    monkeypatch.setattr(codec, "_merge_many", lambda *args: merged.append(len(args[1])) or merge(*args))
    codec.segments(words, list(range(len(words))))
    assert len(words) <= sum(merged) <= 2 * len(words)       # once without skips, once with its own


def test_pairs_of_a_word_are_looked_up_once_for_all_its_occurrences(monkeypatch):
    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        codec = piece_dropout.PieceCodec(f.read(), seed=3, dropout=0.97)
    word, n, looked_up, offer = "\u2581understanding", 2000, [], codec._offer
    monkeypatch.setattr(codec, "_offer", lambda left, right: looked_up.append(len(left)) or offer(left, right))
    keys = [i * 0x9E3779B97F4A7C15 % (1 << 64) for i in range(n)]
    got = codec.segments([word] * n, keys)
    assert [np.frombuffer(x, np.uint32).tolist() for x in got[:50]] == [_plain_agenda(codec, word, np.uint64(k)) for k in keys[:50]]
    assert sum(looked_up) < n * len(word) / 2                # once for the word, and twice for every merge


def test_words_of_texts_equal_a_plain_split():
    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        codec = piece_dropout.PieceCodec(f.read())
    rng = random.Random(7)
    alone = "".join(c for c in "\n\t\r\x0b\x0c" if not any(c in p for p in codec.rank if len(p) > 1))
    plain = re.compile(f"[{alone}]|\u2581+[^\u2581{alone}]*|[^\u2581{alone}]+")
    samples = ["", " ", "\u2581", "\u2581\u2581", "  a \u2581 b\n \n", "\u2580\u2582\U0001f389", "", "\n"]
    samples += ["".join(rng.choice(" \n\t\r\x0b\x0cab\u2581\u2580\u00e9\x00\U0001f389") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    counts, codes, vocabulary = codec._words(samples)
    at = 0
    for text, n in zip(samples, counts):
        want = []
        for i, part in enumerate(text.split("\u2581") if text else []):
            want += [piece_dropout._RAW_MARK] * (i > 0) + plain.findall((part if i else " " + part).replace(" ", "\u2581"))
        assert [vocabulary[c] for c in codes[at:at + n]] == want
        at += n
    assert at == len(codes) and len(set(vocabulary)) == len(vocabulary)


def test_any_text_decodes_to_itself():
    with open(tokenizer_path(PIECE_BPE), "rb") as f:
        codec = piece_dropout.PieceCodec(f.read(), seed=2, dropout=0.3)
    samples = ["\ue000\uf8ff\ue000", "\ue000", "\u2581", "\u2581\n\ue000\uf8ff\ue000\n\u2581\u2581", ""]
    offsets, ids = codec.encode(samples, np.arange(len(samples), dtype=np.uint64))
    assert [codec.decode(ids[a:b]) for a, b in zip(offsets, offsets[1:])] == samples


# ---- 2 line runs in SQL -----------------------------------------------------------
def test_line_runs_equal_sql_on_random_pools(spark):
    import duckdb

    rng = random.Random(5)
    pool = [" ".join(rng.choice("abcdefgh") + str(i) for _ in range(n)) for i, n in enumerate([30, 25, 25, 3, 12, 49, 50, 51, 0, 17, 17, 8])]
    docs = [(0, f"{pool[0]}\n{pool[1]}"), (1, f"{pool[0]}\n{pool[2]}"), (2, f"{pool[0]}\n{pool[2]}"), (3, None), (4, "")]
    docs += [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(5, 90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (len(r.removed), r.clean_text) for r in line_dedup.dedup_lines(df.repartition(3)).collect()}
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = {r[0]: (r[2], r[3]) for r in con.execute(line_dedup.ORACLE_SQL).fetchall()}
    assert got[2] == (2, "") and got == want


# ---- 10 memory of a task ----------------------------------------------------------
def test_a_task_holds_little_more_than_its_batch():
    import tracemalloc

    import pyarrow as pa

    from tallyspark.llm.wordio import text_slices

    rng = np.random.default_rng(0)
    texts = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 5000, 20_000).tolist()) for _ in range(120)])  # 14 MB
    tracemalloc.start()
    for start, stop in text_slices(texts):
        for _ in jaccard_join.shingle_sets(texts.slice(start, stop - start), 4):
            pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


# ---- 5 html ------------------------------------------------------------------------
def test_run_ranks_and_cover_equal_brute_force():
    rng = np.random.default_rng(0)
    stream = rng.integers(0, 3, 200)
    ranks = html_extract.run_ranks(stream, 4)
    spans = [tuple(stream[i:i + 4]) for i in range(197)]
    assert all((spans[i] == spans[j]) == (ranks[i] == ranks[j]) for i in range(197) for j in range(197))
    marked = np.zeros(20, bool)
    marked[[3, 5, 12]] = True
    assert np.flatnonzero(html_extract.covered(marked, 4)).tolist() == [3, 4, 5, 6, 7, 8, 12, 13, 14, 15]


def test_main_text_without_furniture(spark):
    def page(i, body, article=True):
        words = " ".join(f"w{i}x{k}" for k in range(30))
        main = f"<h1>Title {i}</h1><p>{words} &amp; more\n text<br>second &#233; line{body}"
        main = f"<article>{main}</article>" if article else f"<div>{main}</div>"
        return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header><p>Site name</p></header>"
                f"<nav><ul><li><a>Home</a></ul></nav><script>var a='</p>';</script><div class=\"cookie-notice\">We use cookies</div>"
                f"{main}<p>Read our other stories every single day of the week here</p>"
                f"<section class='comments'><p>first!</section><aside>side</aside><form><p>mail</form><footer>&copy; us</footer>")

    rows = [(i, f"https://host.example/{i}", page(i, "", i % 2 == 0)) for i in range(8)]
    rows.append((99, "https://host.example/copy", page(0, "<p>tail")))
    out = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        words = " ".join(f"w{i}x{k}" for k in range(30))
        assert out[i] == f"Title {i}\n{words} & more text\nsecond é line", out[i]
    assert out[99] == out[0] + "\ntail"           # copies do not make each other's text furniture


def test_copies_of_pages_without_article_keep_their_text(spark):
    words = lambda name, n=40: " ".join(f"{name}w{k}" for k in range(n))
    menu = "<div>Read our other stories every single day of the week here</div>"
    page = lambda body: f"<html><body>{menu}{body}</body></html>"
    rows = [(1, "https://a.example/x", page(f"<div>{words('a')}</div>"))] * 3                       # repeated rows
    rows += [(2 + k, f"https://a.example/{k}", page(f"<div>{words('a')}</div><p>tail {k}</p>")) for k in range(2)]
    rows += [(10 + k, f"https://a.example/o{k}", page(f"<div>{words(f'o{k}')}</div>")) for k in range(4)]
    rows += [(20 + k, f"https://b.example/{k}", f"<div>{words('b')}<p>tail {k}") for k in range(6)]  # nothing but near copies
    long = f"<div>{words('template', 60)}</div>"                                                    # a template longer than the text
    rows += [(30 + k, f"https://c.example/{k}", f"{long}<div>{words(f'c{k}', 30)}</div>") for k in range(6)]
    rows += [(40, "https://c.example/copy", f"{long}<div>{words('c0', 30)}</div><p>tail</p>")]
    got = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    out = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and [r.text for r in got if r.page_id == 1] == [words("a")] * 3
    assert [out[2 + k] for k in range(2)] == [f"{words('a')}\ntail {k}" for k in range(2)]
    assert [out[10 + k] for k in range(4)] == [words(f"o{k}") for k in range(4)]
    assert [out[20 + k] for k in range(6)] == [f"{words('b')}\ntail {k}" for k in range(6)]
    assert [out[30 + k] for k in range(6)] == [words(f"c{k}", 30) for k in range(6)] and out[40] == f"{words('c0', 30)}\ntail"


def test_texts_do_not_depend_on_how_a_host_is_dealt(spark):
    rng = random.Random(8)
    words = lambda name, n=40: " ".join(f"{name}w{k}" for k in range(n))
    notice = "we moved our shop to the new house beside the old harbour"
    rows = []
    for host in ("a", "b", "c"):
        menu = f"<nav><p>{words(host + 'menu', 12)}</p><p>{notice}</p></nav>" if host != "b" else ""
        shared = [words(f"{host}s{k}", 15) for k in range(4)]
        for i in range(14):
            parts = [words(f"{host}{i}p{k}", rng.randint(9, 30)) for k in range(4)]
            if rng.random() < 0.5:
                parts.insert(rng.randrange(4), rng.choice(shared))
            if rng.random() < 0.4:
                parts.append(notice)
            if host == "c":
                parts.insert(0, words("template", 25))
            inner = "".join(f"<p>{p}</p>" for p in parts)
            body = f"<article>{inner}</article>" if rng.random() < 0.5 else inner
            rows.append((len(rows), f"https://{host}.example/{i}", menu + body))
            for _ in range(rng.choice([0, 0, 1, 2])):   # near copies, some in other markup
                rows.append((len(rows), f"https://{host}.example/{len(rows)}", menu + body.replace(parts[1], words(f"new{len(rows)}", 12))))
        rows += [rows[-1], (None, f"https://{host}.example/", menu), (None, f"https://{host}.example/", menu), (len(rows), None, menu + notice)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = lambda **how: sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in html_extract.extract_pages(pages, **how).collect())
    whole = text()
    assert len(whole) == len(rows)
    assert text(group_chars=300) == whole and text(group_chars=15_000) == whole


@pytest.mark.parametrize("words", [60, 600])
def test_copies_of_a_host_are_told_by_rows_for_pages_not_for_runs(words):
    shared = " ".join(f"w{k}" for k in range(words))
    own = [f"<article><p>{shared}</p><p>{' '.join(f'p{i % 3}q{k}' for k in range(9 * (i % 3)))}</p></article>" for i in range(30)]
    rows = pa.table({"host": ["h"] * 30, "buckets": pa.array([1] * 30, pa.int64()), "tie": pa.array(range(100, 130), pa.int64()),
                     "page_id": pa.array([None, *range(29)], pa.int64()), "html": own})
    found = html_extract._shared_runs(pa.Table.from_batches(list(html_extract._page_runs(iter(rows.to_batches())))))
    assert found.num_rows <= 2 * 30
    told = [r for r in found.to_pylist() if r["page_id"] is None and r["digest"] is None]
    # three texts, the first page (of the smallest id) of each speaks; the page without id is last and is no first
    assert sorted((r["tie"], r["first"], r["first_article"], r["shown"], r["n"]) for r in told) == [
        (101, 101, 101, 3, words - 7), (102, 101, 101, 3, words - 7), (103, 101, 101, 3, words - 7)]


def test_void_and_unclosed_elements_do_not_cut_the_page():
    texts = lambda source: [text for _, text in html_extract.page_blocks(source)]
    assert texts("<article><p>before<embed src='a.swf'><p>after</article><p>end") == ["before", "after", "end"]
    assert texts("<p>one<embed src='a'></embed> two<embed/> three") == ["one two three"]
    assert texts("<p>before<option>choice<p>after<div>end</div>") == ["before", "after", "end"]
    assert texts("<p>before<button class=x>press<p>after</p><button>press <b>me</b></button> more") == ["before", "after", "more"]
    assert texts("<button><div>label</div></button><p>text<select><option>a<option>b</select> more") == ["text more"]
    assert texts("<p>text<button>press") == ["text"]


def test_articles_of_the_test_pages_come_out_whole(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1|br)>", inner.group(1)) if inner else []
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", b)).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(b for b in plain if b)


# ---- 6 syncmers --------------------------------------------------------------------
def _hash(parts):
    h = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else (p & (2**64 - 1)).to_bytes(8, "little")
        h = xxhash.xxh64_intdigest(data, h)
    return h - 2**64 if h >= 2**63 else h


def _fingerprint(text, k=5, s=2, size=64):
    words = text.replace("\x0b", " ").split()
    if not words:
        return []
    if len(words) < k:
        hashes = [_hash([" ".join(words)])]
    else:
        inner = [_hash(words[i:i + s]) for i in range(len(words) - s + 1)]
        hashes = []
        for i in range(len(words) - k + 1):
            window = inner[i:i + k - s + 1]
            if min(window) in (window[0], window[-1]):
                hashes.append(_hash([*window[0:k - s:s], window[-1]]))
    return sorted({(h & (2**64 - 1)) >> 32 for h in hashes})[:size]


def test_fingerprints_equal_brute_force(spark, texts):
    got = {r.doc_id: r for r in queries.op6_syncmers(spark, SF).collect()}
    order = sorted(texts, reverse=True)
    for i, (doc_id, text) in enumerate(order):
        follower = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + follower[:half]
        mine, other, after = _fingerprint(text), _fingerprint(edited), _fingerprint(follower)

        def near(a, b):
            union = sorted(set(a) | set(b))[:64]
            return len(set(union) & set(a) & set(b)) / len(union) if a and b else float(not a and not b)

        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{v:08x}" for v in mine) and r.edited_fingerprint == "".join(f"{v:08x}" for v in other)
        assert r.near_edited == pytest.approx(near(mine, other)) and r.near_next == pytest.approx(near(mine, after))


def test_anchors_do_not_depend_on_context(spark):
    core = " ".join(f"c{i * 7919 % 1000}" for i in range(40))
    df = spark.createDataFrame([(core,), ("before it stand some words " + core + " and after",)], "text string")
    first, second = [{(a["hash"], a["pos"]) for a in r[0]} for r in df.select(syncmers.anchors(F.col("text"))).collect()]
    assert {(h, p + 5) for h, p in first} <= second


# ---- 7 token counts -----------------------------------------------------------------
def test_counts_equal_the_library_and_come_from_the_cache(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    odd = ["a  b   c\n\n d\t", "\xa0 b  \xa0", "It's 5²3 n't", "<|endoftext|> x<|endoftext|>y", "a ​ b\x1c\x1cd", "", "x,. y!? z*** ,,"]
    rows = texts + [(10_000 + i, t) for i, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cache = scratch_path(spark, "test-digest-cache")
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, tokenizer_path(BYTE_BPE), cache).collect()}
    for doc_id, text in rows:
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[doc_id].n_bytes, got[doc_id].n_tokens, got[doc_id].over_limit) == (len(text.encode()), n, n > 512)
    stored = spark.read.parquet(cache).count()
    assert stored == len({t for _, t in rows})                     # distinct texts only
    more = docs.union(spark.createDataFrame([(77_777, "a new text")], "doc_id long, text string"))
    token_counts.count_tokens(more, tokenizer_path(BYTE_BPE), cache).collect()
    assert spark.read.parquet(cache).count() == stored + 1         # the second run encodes the new text alone


# ---- 8 token-id files ---------------------------------------------------------------
def test_word_encoder_equals_the_library(texts):
    with open(tokenizer_path(WORD_BPE), encoding="utf-8") as f:
        encoder = WordEncoder(f.read(), max_entries=2_000)         # the cache is emptied on the way
    odd = [" a  b ", "", None, "a\x0bb\x0cc\x1cd\xa0e", "<|endoftext|> x<|endoftext|>y", "It's 5²3 n't ÉÀß ＡＢ ﬁ İ ς Σ 'S",
           "é! ,́ ≠ 中文。a", "a,́ É. é́. ª. µ, ×. ÷, Ø!!, .a. ..."]
    samples = odd + [t for _, t in texts]
    offsets, ids = encoder.encode(pa.array(samples), end_id=2)
    for s, a, b in zip(samples, offsets, offsets[1:]):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(s or "", add_special_tokens=False).ids + [2]


def test_huffman_code_is_limited_and_exact():
    import heapq

    rng = np.random.default_rng(0)
    for n, limit in ((1, 18), (2, 1), (7, 3), (300, 9), (300, 18)):
        counts = (rng.pareto(0.6, n) * 5 + 1).astype(np.int64)
        bits = huffman.code_lengths(counts, limit)
        assert bits.max() <= max(limit, int(np.ceil(np.log2(max(n, 2))))) and (0.5 ** bits).sum() <= 1
        if limit == 18 and n > 1 and bits.max() < 18:              # not bound by the limit: as short as plain Huffman
            heap = counts.tolist()
            heapq.heapify(heap)
            cost = 0
            while len(heap) > 1:
                both = heapq.heappop(heap) + heapq.heappop(heap)
                cost += both
                heapq.heappush(heap, both)
            assert cost == int((counts * bits).sum())
        code = huffman.Code(np.arange(n) * 3, bits)
        ids = (rng.integers(0, n, 1000) * 3).astype(np.uint32)
        for size in (0, 1, 63, 64, 65, 1000):
            assert (code.decode(*code.encode(ids[:size]), size) == ids[:size]).all()


def test_files_give_back_every_id(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    got = sorted(queries.op8_huffman_ids(spark, SF).collect())
    start = 0
    for (doc_id, text), r in zip(texts, got):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


# ---- 9 packing ----------------------------------------------------------------------
@pytest.mark.parametrize("parts, open_windows, fan_in", [(1, 32, 32), (5, 3, 2)])
def test_packing_places_every_id_once(spark, texts, parts, open_windows, fan_in):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    ids = {i: np.array(library.encode(t, add_special_tokens=False).ids + [2], dtype="<u4") for i, t in texts}
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(parts)
    out = packing.pack(docs, tokenizer_path(WORD_BPE), open_windows=open_windows, fan_in=fan_in, capacity=1024).toPandas()
    for r in out.itertuples():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for doc_id, group in out.sort_values("start").groupby("doc_id"):
        assert group.start.tolist() == [0, *group.length.cumsum().tolist()[:-1]] and group.length.sum() == len(ids[doc_id])
    used = 0
    for _, group in out.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]] and group.length.sum() <= 1024
        used += 1024
    assert set(out.doc_id) == set(ids) and used / out.length.sum() < 1.05


# ---- 10 similarity join ---------------------------------------------------------------
def _components(rows, k, num, den):
    sets = {}
    for i, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("k, num, den, common_at", [(4, 85, 100, 4), (5, 4, 5, 2), (5, 4, 5, 10_000)])
def test_similarity_join_equals_all_pairs(spark, monkeypatch, k, num, den, common_at):
    monkeypatch.setattr(jaccard_join, "COMMON_AT", common_at)
    if common_at < 4:
        monkeypatch.setattr(jaccard_join, "SMALL", 0)
        monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 5)   # keys in several blocks
    rng = random.Random(k)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, bases = [], [[rng.choice(vocabulary) for _ in range(n)] for n in (3, 9, 30, 80, 200, 700)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for base in bases:
        for copy in range(22):                     # copies of copies: chains at the edge of the threshold
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1 + len(words) // 60, 1 + len(words) // 30])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                base = words
            if rng.random() < 0.2:
                words = words + passage
            rows.append((len(rows), " ".join(words) if copy % 5 else " ".join(words).upper()))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", "  ", "v1", "V1", "v1 v2 v3"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs, k, num, den).collect()}
    assert got == _components(rows, k, num, den)


def test_similarity_join_sends_texts_to_workers_in_small_batches(spark, monkeypatch):
    seen, write = [], jaccard_join.write_table

    def batch_rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    def watched(df, name):   # what a worker gets while the join writes its tables
        seen.append(max(r.n for r in docs.mapInArrow(batch_rows, "n long").collect()))
        return write(df, name)

    docs = spark.createDataFrame([(i, f"a{i} b c d " * 10_000) for i in range(100)], "doc_id long, text string").coalesce(1).cache()
    monkeypatch.setattr(jaccard_join, "write_table", watched)
    out = jaccard_join.near_duplicates(docs, 4, 85, 100)
    assert max(seen) * 100_000 < 6_000_000   # of 11 MB in the one partition
    assert out.count() == 100 and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None
    docs.unpersist()


@pytest.mark.parametrize("block_rows, block_shingles", [(2_000, 2_000_000), (60, 2_000_000), (2_000, 5_000)])
def test_similarity_join_of_a_family_just_under_the_threshold(spark, monkeypatch, block_rows, block_shingles):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block_shingles)
    rng = random.Random(7)
    base, rows = [f"w{i}" for i in range(100)], []
    for i in range(150):   # two replaced words each: a pair links where their places meet
        words = list(base)
        for at in rng.sample(range(4, 96), 2):
            words[at] = f"x{rng.randrange(3)}"
        rows.append((i, " ".join(words)))
    want = _components(rows, 4, 85, 100)
    assert 20 < len({c for _, c in want.values()})   # many components: most pairs do not link
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs, 4, 85, 100).collect()}
    assert got == want


def test_keep_one_tells_texts_of_one_id_apart(spark):
    text = lambda name: " ".join(f"{name}{k}" for k in range(40))
    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (5, text("b")), (6, text("b")), (7, None), (None, text("a"))]
    out = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, text("a")), (5, text("b")), (5, text("b")), (7, None), (None, text("a"))]
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))


def test_linking_sets_share_a_key_and_pass_the_sketch():
    rng = np.random.default_rng(0)
    for size in (7, 8, 15, 60, 333, 2000):
        for commons in (0, 3):
            base = rng.integers(0, 2**63, size, dtype=np.uint64)
            for _ in range(20):
                other = base.copy()
                n = int(rng.integers(0, size // 5 + 1))
                other[:n] = rng.integers(0, 2**63, n, dtype=np.uint64)
                other = other[:size - int(rng.integers(0, size // 8 + 1))]
                a, b = np.unique(base), np.unique(other)
                common = np.sort(rng.choice(a, len(a) * commons // 4, replace=False))
                both = len(np.intersect1d(a, b))
                if 100 * both >= 85 * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                    assert np.intersect1d(jaccard_join.sketch_keys(a, 85, 100, common), jaccard_join.sketch_keys(b, 85, 100, common)).size
                    differ = jaccard_join.hamming(jaccard_join.whole_sketch(a, 85, 100), jaccard_join.whole_sketch(b, 85, 100))
                    assert differ <= len(a) + len(b) - 2 * both <= jaccard_join.largest_difference(len(a), len(b), 85, 100)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (150, 100)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in (100, 150, 200))


def test_quotes_open_a_value_only_after_an_equals_sign():
    texts = lambda source: [text for _, text in html_extract.page_blocks(source)]
    assert texts("<article><p data-x=it's>Hello world</p><p>Second don't stop</p></article>") == ["Hello world", "Second don't stop"]
    assert texts('<p class="a"">One</p><p>Two</p>') == ["One", "Two"]
    assert texts('<p title = "a > b" class=x">One</p><p \'>Two</p>') == ["One", "Two"]
    assert texts("<p =\"a>b\">One<p a=  >Two") == ["One", "Two"]


def test_one_marker_word_in_a_longer_name_keeps_a_block_of_the_article():
    kept = lambda inner: [t for z, t in html_extract.page_blocks(f"<article>{inner}</article>") if z == html_extract.ARTICLE]
    assert kept('<section class="share-price"><p>Up</p></section><h2 id="related-work">Work</h2>') == ["Up", "Work"]
    assert kept('<p>A</p><div class="ad">B</div><div class="share-bar">C</div><div class="social-share-now">D</div><div id="comments">E</div>') == ["A"]
    assert [z for z, _ in html_extract.page_blocks('<div class="share-price">Up</div>')] == [html_extract.CHROME]
