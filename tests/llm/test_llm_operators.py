"""Mixing, URL rules, WARC bundles, BPE, chat formatting, toxicity and quality against brute force and edge cases."""

import base64
import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillflow.llm import bpe, chat, mixing, quality, toxicity, url_rules, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# mixing ------------------------------------------------------------------------------------------------------------

MIX = "doc_id bigint, text string, source string, size string, copies string"


def targets_by_iteration(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
        left, free = left - sum(out[s] for s in over), free - over
    return out


def test_mixing_targets_and_words_taken(spark):
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * r.randint(0, 60)), r.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"]), "x", "y") for i in range(3000)]
    rows += [(1, None, "nulls", "x", "y"), (1, None, "nulls", "x", "y"), (None, "v " * 5000, "a", "x", "y"), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, MIX)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    expected = targets_by_iteration(sizes)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and g["target"] == pytest.approx(expected[g["source"]])
        assert 0 <= g["copies"] <= 2 and g["size"] == len(WORD.findall(g["text"] or ""))
        taken[g["source"]] += g["copies"] * g["size"]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 0.02 * expected[s] + (5000 if s == "a" else 60)
    again = mixing.mix(docs.repartition(7), wide=False).select("doc_id", "size", "copies").collect()
    assert sorted(map(repr, map(tuple, again))) == sorted(repr((g["doc_id"], g["size"], g["copies"])) for g in got)
    emitted = mixing.emit(mixing.mix(docs))
    assert emitted.columns == ["doc_id", "text", "source"] and emitted.count() == sum(g["copies"] for g in got)


def test_mixing_copies_cross_integer_boundaries(spark):
    """Copies of a source's documents, in order, are what the prefix sums plus one offset cross."""
    rows = [(i, "w " * 10, "s", "", "") for i in range(50)] + [(100 + i, "w", "t", "", "") for i in range(700)]
    got = mixing.mix(spark.createDataFrame(rows, MIX), wide=False).collect()
    rate = {g["source_size"]: g["target"] / g["source_size"] for g in got}
    for size, r in rate.items():
        copies = [g["copies"] for g in got if g["source_size"] == size]
        assert set(copies) <= {int(r), int(r) + 1} and abs(sum(copies) - r * len(copies)) <= 1


def test_mixing_empty_and_wordless(spark):
    assert mixing.mix(spark.createDataFrame([], MIX)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, None, "", ""), (2, " ", "a", "", "")], MIX), wide=False).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["copies"]) for r in rows) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


# url rules ---------------------------------------------------------------------------------------------------------

URLS = ["http://A.Example.NET/en/1", "http://example.net/en", "https://x.net", "https://x.net/", "http://notnet/", "http://my-net/a",
        "http://a.example.com/de/", "http://example.com/DE/", "http://b.org/fr/x?y", "http://casino.org/", "http://x.org/a/Poker.html",
        "http://u@x.net/", "http://x.net:80/", "no scheme", "", None, "a://b://c.net/x", "http://x.org/" + "p/" * 20000, "http://Knet/",
        "http://h?x.net/", "http://é.net/en/\n1", "http://h#net/", "ftp://net/x", "http://x.org/pokerface"]


def judge_brute(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_rules.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    tokens = {t.lower() for t in re.findall("[0-9A-Za-z]+", host + path)}
    return host, path, None, "block" if tokens & set(url_rules.SPAM_NAMES) else "allow"


@pytest.mark.parametrize("most", [url_rules.MAX_INDEX_BYTES, 0])
def test_url_verdicts(spark, monkeypatch, most):
    monkeypatch.setattr(url_rules, "MAX_INDEX_BYTES", most)  # 0: rules joined by token
    rows = [(i % 7 if i % 5 else None, u, "x", "y") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    got = [tuple(r)[:5] for r in url_rules.judge(pages).collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, *judge_brute(u))) for i, u, *_ in rows)
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token():
    filed = url_rules.index_rules(url_rules.default_rules())
    assert {r["rule"]: t for t, rs in filed.items() for r in rs}["example.net/en/"] == "en"
    loose = url_rules.host_rule("a.com", "/docs", "block")  # "docs" may go on in a url, so it is no token
    assert loose["tokens"] == ["a", "com"]


# warc --------------------------------------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, payload string, refers_to int"


def test_warc_round_trip(spark, tmp_path):
    r = random.Random(3)
    bodies = ["<p>%d</p>" % i * r.randint(1, 400) for i in range(20)] + ["", "é" * 5000, "x\r\n\r\nWARC/1.1\r\n"]
    rows = [(i, f"http://h/{i}\r\nX: y", r.choice(bodies), "p", 1) for i in range(300)]
    rows += [(1000, None, None, "p", 1), (None, "u", "only null id", "p", 1), (7, "again", rows[7][2], "p", 1), (-5, "u", bodies[0], "p", 1)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    path = str(tmp_path / "w")
    warc.write_bundles(warc.records(pages), path, frame_bytes=3000, bundle_bytes=40_000)
    got = warc.read_records(spark, path).select(warc.page_id(F.col("record_id")), "payload_bytes", "payload_digest", "record_type",
                                                warc.page_id(F.col("refers_to")), "payload").collect()
    first = {}
    for i, _, html, *_ in rows:
        key = html or ""
        if i is not None:
            first[key] = min(first.get(key, i), i)
    expected = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        visit = i != first.get(html or "")
        visit = visit and first.get(html or "") is not None
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if visit else "response",
                         first[html or ""] if visit else None, None if visit else data))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    index = warc.read_index(spark, path).collect()
    assert len(index) == len(rows) and len({x["path"] for x in index}) > 1 and max(x["frame"] for x in index) > 1
    one = index[17]
    bundle = warc.Bundle(open(one["path"].removeprefix("file:"), "rb").read())
    record = warc.parse_record(bundle.frame(one["frame"])[one["offset"]:one["offset"] + one["length"]])
    assert record["warc-record-id"] == one["record_id"]
    wanted = warc.read_records(spark, path, {"<urn:page:12>", "<urn:page:1000>"})
    assert sorted(x["record_id"] for x in wanted.collect()) == ["<urn:page:1000>", "<urn:page:12>"]


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, tmp_path):
    import zstandard
    path = str(tmp_path / "w")
    warc.write_bundles(warc.records(spark.createDataFrame([(1, "u", "<p>", "p", 1)], PAGES)), path)
    file = next((tmp_path / "w").glob("part-*"))
    data = file.read_bytes()
    with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as f:
        assert f.read().startswith(b"WARC/1.1\r\n")
    assert data[-4:] == bytes.fromhex("b1ea928f")


def test_warc_min_revisit_bytes_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab", "p", 1), (2, "u", "ab", "p", 1), (3, "u", "abc", "p", 1), (4, "u", "abc", "p", 1)], PAGES)
    got = warc.records(pages, min_revisit_bytes=3).select("id", "refers_to").collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, None), (3, None), (4, 3)] or sorted(map(repr, map(tuple, got))) == [
        "(1, None)", "(2, None)", "(3, None)", "(4, 3)"]
    warc.write_bundles(warc.records(pages.limit(0)), str(tmp_path / "e"))
    assert warc.read_records(spark, str(tmp_path / "e")).count() == 0


# bpe ---------------------------------------------------------------------------------------------------------------

def bpe_texts():
    r = random.Random(5)
    some = ["", None, " \n", "<|endoftext|>x<|STARTOFTEXT|> <|startoftext|>", "I'll don't we've", "naïve Ça ΣΑΣ İ 漢字 🎉 é ½ \x1c\x85",
            "a" * 3000, "word " * 5000, "!?" * 50 + "9 99"]
    letters = "aaabbcthenirso'.,!é£ 12<|>\n"
    some += ["".join(r.choice(letters) for _ in range(r.randint(1, 80))) for _ in range(400)]
    return some + some[:5]


@pytest.mark.parametrize("group,known", [(1_000_000, 600_000), (64, 20)])
def test_bpe_equals_the_library(spark, monkeypatch, group, known):
    from tokenizers import Tokenizer
    monkeypatch.setattr(bpe, "GROUP_CHARS", group)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", known)
    own = Tokenizer.from_file(bpe.vocabulary_path())
    texts = bpe_texts()
    expected = [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    codec = bpe.Codec(bpe.vocabulary_path())
    got = codec.encode([t or "" for t in texts])
    assert [x.tolist() for x in got] == expected
    back = codec.decode(pa.array(expected, pa.list_(pa.int32()))).to_pylist()
    assert back == [own.decode(x, skip_special_tokens=False) for x in expected]


def test_bpe_frames(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(bpe_texts()[:12])] + [(None, "null id", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, c0 int")
    encoded = bpe.encode(docs, keep=("c0",))
    codec = bpe.Codec(bpe.vocabulary_path())
    expected = {i: codec.encode([t or ""])[0].tolist() for i, t, *_ in rows}
    got = encoded.collect()
    assert {r["doc_id"]: r["ids"] for r in got} == expected and encoded.columns == ["doc_id", "c0", "ids"] and got[0]["c0"] == 1
    assert {r["doc_id"]: r["decoded"] for r in bpe.decode(encoded).collect()}[None] == "null</w> id</w>"
    assert bpe.encode(docs.limit(0)).count() == 0


# chat --------------------------------------------------------------------------------------------------------------

NASTY = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|im_end|>", "<", "|", "a\nb", "", None, "<|" * 50, "\\", "é🎉 <|im_end|>\n", "t" * 50000]


def test_chat_round_trip(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system", "odd\n\\n<|role", "", None]), r.choice(NASTY), "x", "y")
            for c in range(25) for t in range(r.randint(1, 9))]
    rows += [(None, 0, "user", "hi", "x", "y"), (99, None, "assistant", "first", "x", "y"), (99, 0, "user", "second", "x", "y"), rows[0], rows[0]]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, seq string, kind string")
    segments = chat.render(chat.fold(chat.message_events(turns)))
    got = {x["conv_id"]: x for x in chat.read_back(segments).collect()}
    assert set(got) == {x[0] for x in rows}
    whole = {x["conv_id"]: x["text"] for x in chat.formatted(segments).collect()}
    for conv, g in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "",
                                                                       hashlib.sha256((x[3] or "").encode()).hexdigest()))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert g["n_turns"] == len(own) and g["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (g["loss_chars"], g["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g["formatted_chars"] == len(whole[conv]) and whole[conv].count(chat.START) == len(own)
    assert chat.read_back(chat.render(chat.fold(chat.message_events(turns.limit(0))))).count() == 0


def test_chat_folds_deltas_edits_and_regenerations(spark):
    log = [(1, 1, "m1", 0, "open", "user", None), (1, 2, "m1", 0, "delta", None, "he"), (1, 3, "m1", 0, "delta", None, "llo"),
           (1, 4, "m2", 0, "open", "assistant", None), (1, 5, "m2", 0, "delta", None, "bad draft"), (1, 6, "m2", 0, "regenerate", None, None),
           (1, 7, "m2", 0, "delta", None, "good"), (1, 9, "m2", 0, "delta", None, " answer"), (1, 10, "m1", 0, "edit", None, "hello!"),
           (1, 11, "m3", 0, "open", "user", None), (1, 12, "m3", 0, "retract", None, None), (1, 13, "m4", 0, "delta", None, "no role"),
           (1, 14, "m4", 0, "blink", None, "?"), (1, 15, "m5", 0, "open", "user", None), (1, 16, "m5", 0, "retract", None, None),
           (1, 17, "m5", 0, "open", "late", None), (None, None, None, None, "delta", None, None)]
    random.Random(1).shuffle(log)
    got = chat.fold(spark.createDataFrame(log, chat.EVENTS)).collect()
    assert sorted(((m["conv_id"] or 0, m["position"] or 0, m["role"], m["text"]) for m in got)) == [
        (0, 0, "", ""), (1, 1, "user", "hello!"), (1, 4, "assistant", "good answer"), (1, 13, "", "no role"), (1, 15, "user", "")]


# toxicity ----------------------------------------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, lang string, score string, toxic int"


def toxic_rows(seed, n):
    r = random.Random(seed)
    plain = ["la%d" % i for i in range(60)] + "the of and river stone paper light house green slow".split()
    rude = ["zorgle", "blargh", "snurk"]
    docs, labels = [], []
    for i in range(n):
        bad = r.random() < 0.3
        text = [r.choice(plain) for _ in range(r.randint(5, 60))]
        for _ in range(2 * bad):
            text.insert(r.randrange(len(text)), r.choice(rude).upper() + r.choice(["", "s", "ed"]))
        docs.append((i, " ".join(text), "en", "x", 9))
        labels.append((i, None, int(bad)))
    return docs, labels


def test_toxicity_learns_and_ignores_held_out_labels(spark):
    docs, labels = toxic_rows(1, 900)
    docs += [(5000, None, None, None, 1), (5001, "", "en", "x", 1), (None, "blargh", "en", "x", 1), (0, docs[0][1], "en", "x", 1),
             (5002, "river stone " * 200_000 + "ZORGLE blargh snurks", "en", "x", 1)]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    frame = spark.createDataFrame(docs, DOCS)
    lab = lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    model = toxicity.train(frame, lab(labels + [(1, None, None), (None, 1, 1), labels[0]]))
    out = toxicity.score(frame, model)
    got = out.select("doc_id", "text", "score").collect()
    truth = dict((i, t) for i, _, t in labels)
    tested = [(g["score"] >= 0.7) == bool(truth[g["doc_id"]]) for g in got if g["doc_id"] in truth and held(g["doc_id"])]
    assert sum(tested) >= 0.98 * len(tested) and all(0 <= g["score"] <= 1 for g in got)
    by_id = {g["doc_id"]: g["score"] for g in got}
    assert by_id[5000] == by_id[5001] < 0.5 and by_id[5002] > 0.7 and out.columns.count("score") == 1
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    assert toxicity.train(frame, lab(flipped)).bias == pytest.approx(model.bias)


def test_toxicity_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a", "x", "y", 0)], DOCS)
    assert toxicity.score(docs, toxicity.train(docs, empty)).first()["score"] == 0.5
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), empty)).count() == 0


def test_grams_of_slices_equal_those_of_the_whole(monkeypatch):
    text = "".join(random.Random(9).choice("abcdé ") for _ in range(5000))
    whole = toxicity.present(text).tolist()
    monkeypatch.setattr(toxicity, "SLICE", 64)
    assert toxicity.present(text).tolist() == whole


# quality -----------------------------------------------------------------------------------------------------------

def base_brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, at = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            at |= {p + d for p in places for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at))


def test_quality_measures_match_brute_force(spark):
    r = random.Random(6)
    texts = [None, "", " \n\t", "a", "a a a", "a a a a", "a b\n\na b\n a b", "x\x0by\x0cz\r\nq", "é#ü $%&|<>*", "a b c " * 3000, " lead and trail ", "\u00a0x\u2003y"]
    texts += [" ".join(r.choice("abcdef") for _ in range(r.randint(1, 40))) + r.choice(["", "\nabc\nabc"]) for _ in range(100)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "a b c a b c", 1)] * 2, "doc_id bigint, text string, n_words int")
    got = quality.quality(docs).collect()
    assert len(got) == len(texts) + 2
    for g in got:
        text = texts[g["doc_id"]] if g["doc_id"] is not None else "a b c a b c"
        own = base_brute(text)
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == own, text
        assert g["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0]) and not (g["kept"] and g["base_failed"])
    assert quality.quality(docs.limit(0)).count() == 0


def test_quality_model_separates_junk(spark):
    r = random.Random(8)
    vocab = ["w" + "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    good = ["\n".join(" ".join(r.choice(vocab) for _ in range(12)) + "." for _ in range(8)) for _ in range(300)]
    junk = [" ".join(r.choice(vocab) + r.choice(["###", "$$$", "***"]) for _ in range(90)) for _ in range(25)]
    junk += ["\n".join(" | ".join(r.choice(vocab) for _ in range(9)) for _ in range(9)) for _ in range(25)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + junk)], "doc_id bigint, text string")
    kept = {g["doc_id"]: g["kept"] for g in quality.quality(docs).collect()}
    assert sum(kept[i] for i in range(300)) >= 297 and not any(kept[i] for i in range(300, 350))


def test_quality_em_matches_plain_em(spark):
    """The fitted rates are those of the same EM in plain Python over the same votes."""
    r = random.Random(11)
    names = list(quality.RULES)
    rows = []
    for _ in range(400):
        bad = r.random() < 0.2
        rows.append(tuple(r.choices((1, 0, -1), (0.5, 0.1, 0.4) if bad else (0.9, 0.07, 0.03))[0] for _ in names))
    model = quality.fit(spark.createDataFrame(rows, ", ".join(f"v_{n} int" for n in names)))
    good, rates = quality.PRIOR_GOOD, [{y: dict(quality.PRIOR[y]) for y in quality.PRIOR} for _ in names]
    for _ in range(quality.ROUNDS):
        ps = []
        for v in rows:
            a, b = good, 1 - good
            for q, x in zip(rates, v):
                a, b = a * q["good"][x], b * q["bad"][x]
            ps.append(a / (a + b))
        new = []
        for j in range(len(names)):
            got = {y: {x: sum((p if y == "good" else 1 - p) for p, v in zip(ps, rows) if v[j] == x)
                       + quality.PRIOR_SHARE * len(rows) * quality.PRIOR[y][x] for x in quality.VOTES} for y in quality.PRIOR}
            new.append({y: {x: got[y][x] / sum(got[y].values()) for x in quality.VOTES} for y in got})
        moved = max(abs(a[y][x] - b[y][x]) for a, b in zip(rates, new) for y in a for x in a[y])
        good, rates = sum(ps) / len(ps), new
        if moved < quality.SETTLED:
            break
    assert model["good"] == pytest.approx(good)
    for n, q in zip(names, rates):
        assert model["rates"][n]["bad"] == pytest.approx(q["bad"]) and model["rates"][n]["good"] == pytest.approx(q["good"])


def test_quality_em_runs_until_its_rates_settle():
    assert quality.ROUNDS >= 25 and quality.SETTLED <= 1e-4
