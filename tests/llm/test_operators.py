"""Operators against brute force on small tables, and the stated results for odd input."""

from __future__ import annotations

import hashlib
import random
import re
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opinara.llm import bpe, decontaminate, fingerprints, language, linededup, neardup, preference, pseudonyms, queries, toxicity, urlfilter
from opinara.llm.blockmax import BlockMaxIndex

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """Null, empty and repeated rows, a null key, a long text, and columns named like those the operators add."""
    long = "lange Zeile mit vielen Wörtern " * 4000
    rows = [(1, None, "de", "s", 0), (2, "", "de", "s", 0), (3, "a b c d e f g", None, None, None), (3, "a b c d e f g", None, None, None),
            (4, "A B c d e f g", "en", "s", 1), (None, "a b c d e f g", "en", "s", 1), (5, long, "de", "s", 1), (6, "12 ?! 34", "en", "s", 1)]
    docs = spark.createDataFrame(rows, FIELDS)
    return docs.withColumns({c: F.lit(9) for c in ("score", "kept", "key", "doc", "n_lines", "token_ids", "item_id", "term")})


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(queries.TOKENIZER, encoding="utf-8").read())


def test_pseudonyms_keep_format_and_links(spark):
    one = "card 4111 1111 1111 1111, 4111-1111-1111-1111; ip 10.0.0.7; on 2020-02-29, 2/29/2020; ssn 123-45-6789; +1 (743) 555-3824; a.B+7@x.example.com"
    plain = "order 4111111111111112 version 1.2.3.4.5 on 2021-13-01, 000-12-1234, 10.0.0.256, 3.14 and 1,000"
    out = pseudonyms.pseudonymise(texts(spark, one, plain, one, None, ""), "secret").orderBy("doc_id").collect()
    assert [r.n_replaced for r in out] == [8, 0, 8, 0, 0]
    assert out[0].text == out[2].text != one and out[1].text == plain and out[3].text is None
    shape = lambda t: "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in t)
    assert [len(x) for x in out[0].text.split(";")][0] == len(one.split(";")[0])
    first, second = out[0].text.split(";")[0][5:].split(", ")
    assert first.replace(" ", "") == second.replace("-", "")
    assert shape(out[0].text.split("; ")[-1]) == shape(one.split("; ")[-1])
    y, md = out[0].text.split("; ")[2][3:].split(", ")
    assert [int(x) for x in y.split("-")] == [int(md.split("/")[i]) for i in (2, 0, 1)]
    assert pseudonyms.pseudonymise(texts(spark, one), "other").first().text != out[0].text


def test_pseudonyms_in_lists_and_beside_numbers(spark):
    lines = [
        ("123-45-6789,987-65-4321,321-45-6789", ["123-45-6789", "321-45-6789"]), ("4111111111111111,5500005555555559", ["4111111111111111", "5500005555555559"]),
        ("2020-02-29,10.0.0.7", ["2020-02-29", "10.0.0.7"]), ("at 2020-02-29T10:00", ["2020-02-29"]), ("4111 1111 1111 1111 123", ["4111 1111 1111 1111"]),
        ("room 12 4111111111111111", ["4111111111111111"]), ("2024 555-123-4567", ["555-123-4567"]), ("10.0.0.1-10.0.0.7", ["10.0.0.1", "10.0.0.7"]),
        ("1,4111-1111-1111-1111,a@b.org", ["4111-1111-1111-1111", "a@b.org"]), ("x 1.4111111111111111 4111111111111111a 4111111111111111.5", []),
        ("1-2020-02-29, 123-45-6789-1, 2020-02-29x, 1.2.3.4.5", []),
    ]
    out = pseudonyms.pseudonymise(texts(spark, *(t for t, _ in lines)), "secret").orderBy("doc_id").collect()
    for (text, values), row in zip(lines, out):
        assert row.n_replaced == len(values), text
        assert not any(v in row.text for v in values) and (values or row.text == text)
    pair = pseudonyms.pseudonymise(texts(spark, "4111111111111111", "7 4111111111111111,1"), "secret").orderBy("doc_id").collect()
    assert pair[1].text == f"7 {pair[0].text},1"


def test_feistel_is_a_bijection(spark):
    digits = spark.range(17 * 43).select(F.struct(
        F.lit("x").alias("format"), F.array((F.col("id") / 43).cast("long"), F.col("id") % 43).alias("values"),
        F.array(F.lit(17).cast("long"), F.lit(43).cast("long")).alias("radices")).alias("code"))
    made = {tuple(r.m) for r in digits.select(pseudonyms.permute(F.col("code"), "k").alias("m")).collect()}
    assert made == {(a, b) for a in range(17) for b in range(43)}


def test_preference_prefix_and_masks(spark):
    fields = "pair_id long, turn int, role string, text string, extra int"
    a = [(1, 0, "user", "hi", 1), (1, 1, "assistant", "yes <|im_end|>", 1), (2, 0, "user", "x", 1), (3, 0, "user", None, 1), (None, 0, "user", "q", 1)]
    b = [(1, 0, "user", "hi", 1), (1, 1, "assistant", "no", 1), (2, 0, "user", "x", 1), (2, 0, "user", "x", 1), (3, 0, "user", "", 1)]
    out = {r.pair_id: r for r in preference.preference_pairs(spark.createDataFrame(a, fields), spark.createDataFrame(b, fields)).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].prompt == "<|im_start|>user\nhi<|im_end|>\n" and out[1].prompt_turns == 1
    begin, end = out[1].chosen_mask[0]
    assert out[1].chosen[begin:end] == "yes <| im_end |><|im_end|>"
    begin, end = out[1].rejected_mask[0]
    assert out[1].rejected[begin:end] == "no<|im_end|>"
    assert not out[2].differs and out[2].chosen == "" and out[3].prompt_turns == 0 and out[3].differs
    assert preference.preference_pairs(spark.createDataFrame([], fields), spark.createDataFrame([], fields)).count() == 0


def test_bpe_equals_the_library(spark, library, vocabulary):
    rng, encoder, decoder = random.Random(4), bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    parts = ["the", "'s", " ", "\n", "aa", "-", "<|endoftext|>", "é", "1", "\t", "'ll", "𝔘", "!", "　", "'"]
    cases = ["", " ", "  a", "'" * 5000, "ab" * 30000, " " * 40000 + "x", "é" * 33000, "the " * 9000 + "<|endof"]
    cases += ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(200)]
    cases += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(300, 4000))) for _ in range(40)]
    for case in cases:
        ids = encoder.encode(case)
        assert ids.tolist() == library.encode(case, add_special_tokens=False).ids
        assert decoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_transducer_emits_only_stable_tokens(vocabulary):
    rng = random.Random(8)
    for _ in range(30):
        piece = "".join(rng.choices(["the", "ing", "er", "tion", "=", "-", "a"], k=1500)).encode()
        transducer, got, held = bpe.MergeTransducer(vocabulary), [], 0
        for i in range(0, len(piece), 97):
            got += transducer.feed(piece[i : i + 97])
            held = max(held, len(transducer.rest))
        assert got and got + transducer.close() == bpe.merge(piece, vocabulary)
        assert held <= 3 * vocabulary.lookahead + 97


def test_decoder_replaces_ill_formed_bytes(vocabulary):
    decoder = bpe.Decoder(vocabulary)
    first = [i for i, b in vocabulary.token_bytes.items() if b == "é".encode()[:1]]
    assert decoder.decode(bpe.np.array(first)) == "�"


def test_bpe_on_odd_rows(spark):
    docs = odd_docs(spark)
    tokenizer = bpe.broadcast_tokenizer(spark, queries.TOKENIZER)
    out = bpe.decode(bpe.encode(docs, tokenizer), tokenizer).collect()
    assert len(out) == 8 and all(r.decoded == (r.text or "") for r in out)
    assert bpe.encode(docs.limit(0), tokenizer).count() == 0


def test_bpe_in_one_pass(spark):
    docs = odd_docs(spark)
    tokenizer = bpe.broadcast_tokenizer(spark, queries.TOKENIZER)
    both, one = bpe.decode(bpe.encode(docs, tokenizer), tokenizer), bpe.encode_and_decode(docs, tokenizer)
    assert one.schema == both.schema
    assert sorted(map(repr, one.collect())) == sorted(map(repr, both.collect()))
    assert bpe.encode_and_decode(docs.limit(0), tokenizer).count() == 0


def test_tasks_need_one_python_worker(spark, data, capsys):
    import corpus_pipeline as p

    docs = queries.table(spark, data, "documents")
    p.tokenize(spark, docs, data).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    decontaminate.contaminated(docs, queries.table(spark, data, "benchmark")).explain()
    assert "ExistingRDD" not in capsys.readouterr().out  # rows of the driver come through workers of another kind


def test_contaminated_without_items(spark):
    docs = odd_docs(spark)
    out = decontaminate.contaminated(docs, spark.createDataFrame([], "item_id long, text string"))
    assert out.columns == ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"] and out.count() == 0


def test_workers_load_no_pandas():
    code = "import sys, opinara.llm.language, opinara.llm.neardup, opinara.llm.bpe; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2]).returncode == 0


def test_fingerprints_follow_the_order_of_keys(spark, data):
    docs = queries.table(spark, data, "documents")
    whole = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(whole, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    out = fingerprints.compare_with_edits(docs).collect()
    alone = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert len(out) == len(whole)
    for r in out:
        text = fingerprints.edited(whole[r.doc_id], whole[following[r.doc_id]])
        assert r.edited_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.n_chars == len(whole[r.doc_id])
        assert r.fingerprint == alone[r.doc_id]
        if r.n_chars > 500:
            assert r.near_edited > r.near_next or r.near_next > 0.3
    of_text = defaultdict(set)
    for i, mark in alone.items():
        of_text[whole[i]].add(mark)
    assert all(len(v) == 1 for v in of_text.values())


def test_parsing_is_local():
    rng = random.Random(2)
    middle = "".join(rng.choices("abcdefgh ", k=4000))
    _, sketches = fingerprints.parse([middle, "xy" * 7 + middle, "q" * 31 + middle + "zz", "".join(rng.choices("abcdefgh ", k=4000))])
    like = [float(fingerprints.likeness(sketches[:1], sketches[i : i + 1])[0]) for i in (1, 2, 3)]
    assert like[0] > 0.9 and like[1] > 0.9 and like[2] < 0.3


def test_fingerprints_of_odd_rows(spark):
    out = fingerprints.compare_with_edits(odd_docs(spark)).collect()
    assert len(out) == 8 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert fingerprints.compare_with_edits(odd_docs(spark).limit(0)).count() == 0
    assert fingerprints.compare_with_edits(texts(spark, "only one")).first().near_next == 1


def test_language_on_held_out_rows(spark, data):
    out = queries.op5_language_id(spark, data).join(queries.table(spark, data, "documents"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in out)


def test_language_without_letters_and_with_many_labels(spark):
    rows = [(i, f"wort{i % 7} und satz", "de" if i % 3 else f"noise{i}") for i in range(60)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_languages=3)
    assert len(model.languages) == 3 and "de" in model.languages
    odd = spark.createDataFrame([(1, "\u263a\ufe0f"), (2, "1\ufe0f\u20e3 2"), (3, "wort1 und satz")], "doc_id long, text string")
    assert [r.lang_pred for r in language.predict(odd, model).orderBy("doc_id").collect()] == ["und", "und", "de"]


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark)
    out = language.predict(docs, language.train(docs)).collect()
    assert len(out) == 8 and {r.doc_id for r in out if r.lang_pred == "und"} == {1, 2, 6}
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def brute_groups(whole, words, percent):
    """Components by comparing all pairs."""
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    sets, root = {i: shingles(t) for i, t in whole.items()}, {i: i for i in whole}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in whole}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    rng = random.Random(words)
    base = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(4, 120))) for _ in range(12)]
    whole = {}
    for i in range(150):
        w = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 50)}"
        whole[i] = " ".join(w).upper() if i % 9 == 0 else " ".join(w)
    whole |= {200: "", 201: None, 202: "one", 203: "ONE", 204: "two"}
    docs = spark.createDataFrame(list(whole.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, words=words).collect()}
    assert got == brute_groups(whole, words, 80)


def test_a_pair_meets_in_one_of_its_bands(spark):
    rows = spark.createDataFrame([(([5, -7, 9],), ([9, -7],)), (([1],), ([2],))], "x struct<open:array<bigint>>, y struct<open:array<bigint>>")
    assert [r[0] for r in rows.select(neardup.first_shared(F.col("x"), F.col("y"))).collect()] == [-7, None]


def counted(monkeypatch, module):
    """Rows of the staged tables of a module by name, in order."""
    made, whole = {}, module.stage

    def stage(df, name):
        out = whole(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(module, "stage", stage)
    return made


def test_pairs_just_below_the_threshold_make_no_rows(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    # Two of these share 190 of 208 shingles or, with the first, 191 of 207: similar, but no link at 94 %.
    whole = {i: " ".join([*base[: 6 * i], f"x{i}", f"v{i}", *base[6 * i + 2 : -3], f"y{i}", f"z{i}", f"u{i}"]) for i in range(30)}
    made = counted(monkeypatch, neardup)
    docs = spark.createDataFrame(list(whole.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, words=2, percent=94).collect()}
    assert got == brute_groups(whole, 2, 94) and len({c for _, c in got.values()}) == 30
    assert made["pairs"][0] == 29 and made["pairs"][1:] == [0, 0]


def test_parities_lose_no_link(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        n, apart = rng.choice([5, 50, 900, 6000]), rng.random() / 4
        common = neardup.np.array([rng.getrandbits(64) for _ in range(n)], "uint64")
        x, y = (neardup.np.array([rng.getrandbits(64) for _ in range(round(n * apart * rng.random()))], "uint64") for _ in "xy")
        x, y = (neardup.np.concatenate([common, v]) for v in (x, y))
        link = 100 * n >= 80 * (len(x) + len(y) - n)
        rows.append((link, (len(x), neardup.parities(x).tolist()), (len(y), neardup.parities(y).tolist())))
    sets = spark.createDataFrame(rows, "link boolean, x struct<n:long,odd:array<long>>, y struct<n:long,odd:array<long>>")
    told = sets.select("link", neardup.few_apart(F.col("x"), F.col("y"), 80).alias("may")).collect()
    assert all(r.may for r in told if r.link) and any(not r.may for r in told)


def test_near_duplicates_of_odd_rows(spark):
    out = neardup.near_duplicates(odd_docs(spark)).collect()
    assert len(out) == 8 and {(r.doc_id, r.component_id, r.kept) for r in out} == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (None, None, True), (5, 5, True), (6, 6, True)}
    assert neardup.near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_lines_of_odd_rows(spark):
    line = "a line that is long enough to be compared"
    docs = texts(spark, f"{line}\nshort\n\nx", f"{line}s\nshort\nshorts", None, "", f"{line[:9]}X{line[10:]}\n{line}\nend", line + "s")
    repeated = docs.union(docs.filter("doc_id = 4")).withColumns({"n_lines": F.lit(5), "extra": F.lit(1)})
    out = linededup.dedup_lines(repeated).collect()
    assert {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out} == {
        (0, f"{line}\nshort\n\nx", 4, 0), (1, "shorts", 3, 2), (2, None, 0, 0), (3, "", 1, 0), (4, "end", 3, 2), (5, "", 1, 1)}
    assert len(out) == 7 and linededup.dedup_lines(repeated.limit(0)).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("paired", [2, 16])
def test_lines_within_two_edits_equal_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(linededup, "PAIRED", paired)
    rng = random.Random(4)
    bases = ["".join(rng.choice("abcd ") for _ in range(n)).strip() + "é" for n in (18, 20, 21, 40)]
    lines = []
    for _ in range(90):
        line = list(rng.choice(bases))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(line))
            line[at : at + rng.randrange(2)] = rng.choice(["", "x", "a", "bc"])
        lines.append("".join(line))
    want = [i for i, x in enumerate(lines) if any(
        x == y or min(len(x), len(y)) >= 20 and edit_distance(x, y) <= 2 for y in lines[:i])]
    one = [i for i, x in enumerate(lines) if any(
        x == y or min(len(x), len(y)) >= 20 and edit_distance(x, y) <= 1 for y in lines[:i])]
    docs = texts(spark, *("\n".join(lines[i : i + 3]) for i in range(0, 90, 3)))
    got = {e: sorted(3 * r.doc + r.pos for r in linededup.dropped_lines(docs, edits=e).collect()) for e in (1, 2)}
    assert got == {1: one, 2: want} and len(one) < len(want) < 90


@pytest.mark.parametrize("paired", [2, 1024])
def test_lines_within_two_edits_of_crowds_equal_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(linededup, "FEW", 1)
    test_lines_within_two_edits_equal_brute_force(spark, monkeypatch, paired)


def test_lines_that_share_a_third_with_few_are_not_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(8)
    lines = [f"{g:05d}{'a' * 15}" + "".join(rng.choice("abcdefgh") for _ in range(30)) for g in range(20) for _ in range(5)]
    near = lines[7][:30] + "X" + lines[7][31:-1]
    cut, near_two = [], linededup._near_two
    monkeypatch.setattr(linededup, "_near_two", lambda texts, *more: cut.append(texts.count()) or near_two(texts, *more))
    docs = texts(spark, *lines, near)
    keys = linededup._occurrences(docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("h"), "text"), 20, 2)
    assert [r.doc for r in linededup.dropped_lines(docs, edits=2).collect()] == [100] and cut == [0]
    assert keys.agg(F.max(F.size("halves"))).first()[0] <= 10


def test_block_maxima_are_exact():
    rng = bpe.np.random.default_rng(3)
    pairs = bpe.np.unique(rng.integers(0, 40, (900, 2)) * [1, 5] + [0, 1], axis=0)
    weights = rng.random(len(pairs))
    index = BlockMaxIndex(40, 200, pairs[:, 0], pairs[:, 1], weights, 8)
    for _ in range(50):
        terms, query = rng.choice(40, 6, replace=False), rng.random(6)
        full = bpe.np.zeros(200)
        for t, q in zip(terms, query):
            full[pairs[pairs[:, 0] == t, 1]] += q * weights[pairs[:, 0] == t]
        items, scores = index.above(terms, query, 0.7)
        assert items.tolist() == bpe.np.flatnonzero(full >= 0.7).tolist() and bpe.np.allclose(scores, full[items])
        best, scores = index.top(terms, query, 5)
        assert bpe.np.allclose(scores, bpe.np.sort(full[full > 0])[::-1][:5])
        found = [x for _, x, _ in index.above_each(bpe.np.zeros(6, int), bpe.np.sort(terms), 0.9)]
        ones = sum(bpe.np.bincount(pairs[pairs[:, 0] == t, 1], weights[pairs[:, 0] == t], 200) for t in terms)
        assert (found[0].tolist() if found else []) == bpe.np.flatnonzero(ones >= 0.9).tolist()


def test_contamination_finds_every_verbatim_item(spark, data):
    docs, items = queries.table(spark, data, "documents"), queries.table(spark, data, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    held = items.collect()
    verbatim = {(d.doc_id, i.item_id) for d in docs.collect() for i in held if i.text in (d.text or "")}
    assert verbatim and verbatim <= got
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(odd_docs(spark), items).count() == 0


def test_contamination_folds_case_and_punctuation(spark, data):
    held = queries.table(spark, data, "benchmark").collect()
    text = lambda i: i.text + (" ¿Où est l'Été? Die Straße." if i.item_id % 2 else "")
    items = spark.createDataFrame([(i.item_id, text(i)) for i in held], "item_id long, text string")
    changes = [str.upper, lambda t: re.sub(r"[^\w\s]", " — ", t), lambda t: re.sub(r"([^\W\d_]+)", r"«\1»", t).upper()]
    docs = spark.createDataFrame([(3 * i.item_id + j, f"before it {change(text(i))} after it") for i in held for j, change in enumerate(changes)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert {(3 * i.item_id + j, i.item_id) for i in held for j in range(3)} <= got
    short = spark.createDataFrame([(1, "ÉTÉ À L'ÎLE ÉLOIGNÉE; ÇA ÉTAIT DÉJÀ ÉCRIT")], "doc_id long, text string")
    one = spark.createDataFrame([(1, "été à l’île éloignée. ça était déjà écrit")], "item_id long, text string")
    assert [r.score for r in decontaminate.contaminated(short, one).collect()] == [pytest.approx(1)]


def test_toxicity_folds_case(spark):
    rows = [(i, f"w{i % 7} w{i % 5} " + ("éçœûr" if i % 4 == 0 else "ruhig")) for i in range(80)] + [(99, "ÉÇŒÛR")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    got = toxicity.score(docs.filter("doc_id = 99"), toxicity.train(docs, labels)).first()
    assert got.score >= 0.5 and got.evidence


def test_url_trie_equals_the_join(spark, data):
    urls = ["http://A.Example.org/en/12?x", "http://example.org/en/2", "https://org/x", "http://org", "no url", None, "http://x.com/fr/", "http://x.com/fr", "http://u.com/de/#/fr/", "a://b://c.org/d",
            "http://x.com?u=http://y.com/de/z", "http://x.com#http://y.com/fr/", "http://a.example.org?next=http://b.org/es/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, verdict int")
    rules = spark.createDataFrame([*queries.URL_RULES, ("block", "com", "/fr/"), ("block", None, "/")], "verdict string, host string, path string")
    trie = urlfilter.judge_urls(pages, rules).collect()
    joined = urlfilter.judge_urls(pages, rules, max_broadcast_rules=2).collect()
    assert sorted(map(tuple, trie)) == sorted(map(tuple, joined))
    assert [(r.rule, r.verdict) for r in sorted(trie)] == [
        ("example.org/en/1", "block"), ("org/", "allow"), ("org/", "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("com/fr/", "block"), (None, "allow"), ("com/de/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert {(r.host, r.path) for r in trie if r.page_id > 9} == {("x.com", ""), ("a.example.org", "")}
    assert urlfilter.judge_urls(pages, rules.limit(0)).filter("rule IS NULL").count() == len(urls)


def test_toxicity_learns_stems_and_words(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(300):
        words = [f"w{rng.randint(0, 90)}" for _ in range(30)]
        bad = i % 6 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(["vilest", "grubby" + rng.choice(["a", "en", "ich", "ou"])])
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    known = F.col("doc_id") % 5 != 1
    model = toxicity.train(docs.filter(known), labels.filter(known))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all((got[i].score >= 0.5) == bool(m) for i, m in marks)
    assert all(got[i].evidence for i, m in marks if m)
    out = toxicity.score(odd_docs(spark), model).collect()
    assert len(out) == 8 and all(r.score < 0.5 and not r.evidence for r in out)
    nothing = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_pipeline_stages_take_effect(spark, data):
    import corpus_pipeline as p

    docs = queries.table(spark, data, "documents")
    for name, apply in p.STAGES:
        after = apply(spark, docs, data)
        if name != "tokens":
            assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), after.schema)
        assert 0 < after.count() <= docs.count()
        docs = after
    assert docs.filter(~F.col("round_trip")).count() == 0
