"""License scans, language ID, toxicity and SentencePiece: brute force, the library, held-out accuracy."""
import pickle
import random
import re

import numpy as np
import pytest

from cases import LONG, ODD_TEXTS, SCHEMA, odd_rows, with_extra
from marketlake.llm import langid, license_scan, sentencepiece_bpe, toxicity

LICENSED = [
    "GNU General Public License", "the MIT License, MIT-license mit  license", "cc by", "CC BY-NC-SA 4.0 and cc by",
    "Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0", "apachelicense",
    "released under the terms of the GNU General Public License version 3 or GNU Lesser General Public License",
    "mit lizenz", "cc  by cc\nby cc by", "(MIT) license.", "ÀMIT license", "see https://opensource.org/licenses/mit",
    "All rights reserved. Proprietary and confidential", "gplv3 wtfpl zlib/libpng license",
    "the mit license " * 2000,
]
# whole texts without a title, and what they are
BODIES = {
    "mit": """Copyright (c) 2020 A. Person
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY
OF ANY KIND. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.""",
    "bsd,bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation. 3. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this software without
specific prior written permission.""",
    "bsd,bsd-4-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: All advertising materials mentioning features or use of this software must
display the following acknowledgement: This product includes software developed by the university.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.""",
    "0bsd": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted. THE SOFTWARE IS PROVIDED "AS IS".""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. 3. This notice may not be removed or altered from
any source distribution.""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "apache-2.0": """Licensed to you; you may not use this file except in compliance with the License. Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS.""",
    "mpl-2.0": "If a copy of the MPL was not distributed with this file, You can obtain one at https://example.org/.",
    "bsl-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software").""",
}


def test_license_bodies_without_titles(spark):
    rows = [(i, t, None, None, 1) for i, t in enumerate([*BODIES.values(), "Permission is granted to leave the room."])]
    got = license_scan.summary(license_scan.scan(spark.createDataFrame(rows, SCHEMA))).orderBy("doc_id").collect()
    assert [r.labels for r in got] == [*BODIES, ""]
    assert all(r.score >= 0.75 and r.n_base == 0 for r in got[:-1]) and got[-1].score == 0
    rules = license_scan.default_rules()
    bodies = license_scan.NOTICES + license_scan.CLAUSES
    assert len(bodies) == len(set(bodies)) >= 120 and len(rules) >= 480
    assert all(set(r.keywords) <= set(re.findall("[a-z0-9]+", r.regex)) and r.keywords for r in rules)


def brute_scan(text, rules):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    joined = f" {' '.join(ws)} "
    places = []
    for n, rule in enumerate(rules):
        for m in re.finditer(f"(?<= )(?:{rule.regex})(?= )", joined):
            start = joined.count(" ", 0, m.start()) - 1
            places.append((start, start + len(m.group().split()), rule.priority, n, rule))
    return len(ws), places


def test_license_scan_matches_brute_force(spark):
    rules = license_scan.default_rules()
    texts = LICENSED[:-1] + ODD_TEXTS + [*BODIES.values()]
    df = with_extra(spark.createDataFrame([(i % 9 or None, t, None, None, i) for i, t in enumerate(texts)], SCHEMA))
    got = license_scan.summary(license_scan.scan(df)).collect()
    want = []
    for i, t in enumerate(texts):
        n, places = brute_scan(t, rules)
        kept = [a for a in places if not any(
            b is not a and b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2]
            and ((b[0], b[1]) != (a[0], a[1]) or (b[2], -b[3]) > (a[2], -a[3])) for b in places)]
        base = [a for a in places if a[4].base]
        names = sorted({a[4].label for a in base})
        starts = [a[0] for a in base]
        want.append((i % 9 or None, n, len(base), min(starts, default=None), max(starts, default=None),
                     ",".join(names), ",".join(sorted(set(names) | {a[4].label for a in kept})), len(kept)))
    assert [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.n_kept)
            for r in got] == want
    assert all(0 <= r.score <= 1 for r in got)


def test_license_scan_many_places_and_plan(spark):
    df = spark.createDataFrame([(1, LICENSED[-1], None, None, 1)], SCHEMA)
    out = license_scan.summary(license_scan.scan(df))
    r = out.first()
    assert (r.n_base, r.first_word, r.last_word, r.n_kept) == (2000, 1, 5998, 2000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert len(license_scan.default_rules()) >= 300


def test_license_scan_empty_table_and_rules(spark):
    assert license_scan.scan(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="keyword"):
        license_scan.scan(spark.createDataFrame([], SCHEMA), rules=[license_scan.Rule("x", "x", (), 1)])


# --- language ID -----------------------------------------------------------------------------------

SYLLABLES = {"aa": "ka lo mi ra su to".split(), "bb": "schi zu ver ung heit der".split(), "cc": "que ou ai tre eau es".split()}


def language_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(25))
        rows.append((i, text.capitalize() + ".", lang, "s", 1))
    return rows


def test_langid_held_out_accuracy_and_odd_rows(spark):
    rows = language_rows(400, 1)
    df = with_extra(spark.createDataFrame(rows, SCHEMA))
    model = langid.train(df, where=langid.learnable(langid.F.col("doc_id")))
    assert model.languages == sorted(SYLLABLES)
    truth = {r[0]: r[2] for r in rows}
    held = spark.createDataFrame(rows, SCHEMA).filter(~langid.learnable(langid.F.col("doc_id")))
    got = langid.predict(held, model).collect()
    assert len(got) > 50 and np.mean([truth[r.doc_id] == r.lang_pred for r in got]) > 0.98
    odd = langid.predict(with_extra(spark.createDataFrame(odd_rows(), SCHEMA)), model).collect()
    texts = [r[1] for r in odd_rows()]
    for r, t in zip(odd, texts, strict=True):
        has_letter = any(c.isalpha() for c in t or "")
        assert (r.lang_pred == "und") == (not has_letter) and 0 <= r.score <= 1
    noise = spark.createDataFrame([(1, "xq zzkw pfft wxyz " * 20, "", "", 1)], SCHEMA)
    assert langid.predict(noise, model).first().rejected
    assert langid.predict(noise, model, reject=True).first().lang_pred == "und"


def test_langid_learns_a_language_of_long_texts_only(spark):
    """``bb`` has only texts over SAMPLE_CHARS; the others have short ones."""
    rows = [(i, t * (1 + 25_000 // len(t)) if lang == "bb" else t, lang, s, n)
            for i, t, lang, s, n in language_rows(60, 7)]
    assert min(len(r[1]) for r in rows if r[2] == "bb") > langid.SAMPLE_CHARS
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.train(df)
    assert model.languages == sorted({r[2] for r in rows})
    assert all(r.lang_pred == rows[r.doc_id][2] for r in langid.predict(df, model).collect())


def test_langid_draws_short_texts_first_and_ends_at_the_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 10)
    sizes = {"a": [300], "b": [5] * 6 + [25] * 4, "c": [15, 40, 160], "d": [3] * 9}
    rows = [(f"{lang}{k}", "x" * n, lang) for lang, ns in sizes.items() for k, n in enumerate(ns)]
    drawn = langid.draw(spark.createDataFrame(rows, "doc_id string, text string, lang string"), "lang", 8).collect()
    got = {lang: sorted(len(r.text) for r in drawn if r.lang == lang) for lang in sizes}
    assert got == {"a": [300], "b": [5] * 6 + [25] * 2, "c": [15, 40], "d": [3] * 8}


def test_kneser_ney_probabilities_sum_to_one():
    counts = {"abab": 3, "abc": 2, "cab": 1}
    model = langid.estimate(["x"], [langid.count_grams(counts)])
    letters = "abc" + langid.TAIL
    known = sum(np.exp(-(model.costs(["ab" + c])[0, 0] - model.costs(["ab"])[0, 0])) for c in "abc")
    assert 0 < known
    # of a context: all continuations and the uniform rest make up one
    code = {c: model.costs([c])[0, 0] for c in "abc"}
    assert code["a"] < code["b"] and len(letters) == 4
    context = np.array([ord(langid.HEAD)], dtype=np.uint64)
    total = 0.0
    for c in letters:
        gram = langid.gram_hashes(np.concatenate([context, np.array([ord(c)], dtype=np.uint64)]), 2)[1:]
        at, hit = model.logs[1].find(gram)
        if hit[0]:
            total += np.exp(-model.logs[1].values[at[0], 0])
        else:
            uni = langid.gram_hashes(np.array([ord(c)], dtype=np.uint64), 1)
            a1, h1 = model.logs[0].find(uni)
            b, hb = model.backoffs[0].find(langid.gram_hashes(context, 1))
            total += np.exp(-model.backoffs[0].values[b[0], 0] - model.logs[0].values[a1[0], 0])
    rest = (langid.ALPHABET - 4) / langid.ALPHABET
    passed = np.exp(-model.backoffs[0].values[model.backoffs[0].find(langid.gram_hashes(context, 1))[0][0], 0])
    unigram = np.exp(-model.backoffs[-1].values[0, 0])
    assert total + rest * passed * unigram == pytest.approx(1)


def test_langid_without_training_rows(spark):
    df = spark.createDataFrame([(1, "abc", None, None, 1)], SCHEMA)
    model = langid.train(df)
    r = langid.predict(df, model).first()
    assert (r.lang_pred, r.score) == ("und", 0.0)
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.predict(empty, langid.train(empty)).collect() == []


# --- toxicity --------------------------------------------------------------------------------------

def toxic_rows(n, seed):
    rng = random.Random(seed)
    common = ["".join(rng.choice("aeiounrstl") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        ws = [rng.choice(common) for _ in range(rng.randint(60, 200))]
        if toxic:
            for _ in range(max(2, len(ws) // 30)):
                ws[rng.randrange(len(ws))] = rng.choice(["vilewretch", "scumbag", "idiotic", "vilefool"])
        rows.append((i, " ".join(ws), "en", "s", 1))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    return rows, labels, {r[0]: int(any(w in r[1] for w in ("vile", "scumbag", "idiotic"))) for r in rows}


def test_toxicity_held_out_and_odd_rows(spark):
    rows, labels, truth = toxic_rows(900, 3)
    docs = with_extra(spark.createDataFrame(rows, SCHEMA))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks, where=toxicity.learnable(toxicity.F.col("doc_id")))
    assert 0.1 < model.prior < 0.3
    held = spark.createDataFrame(rows, SCHEMA).filter(~toxicity.learnable(toxicity.F.col("doc_id")))
    got = toxicity.score(held, model).collect()
    y = np.array([truth[r.doc_id] for r in got])
    p = np.array([r.predicted for r in got])
    assert p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.05
    odd = toxicity.score(with_extra(spark.createDataFrame(odd_rows(), SCHEMA)), model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r.score <= 1 for r in odd)
    assert odd[0].predicted == 0 and odd[1].predicted == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert {(r.score, r.predicted) for r in toxicity.score(docs, model).collect()} == {(0.0, 0)}


def test_toxicity_learns_from_long_texts(spark):
    """Every toxic text is a long one, and labels without a document or a text take no one's place."""
    rows, labels, truth = toxic_rows(300, 4)
    filler = " ".join(sorted({w for r in rows for w in r[1].split() if not truth[r[0]]})[:250])
    rows = [(i, t + f" {filler}" * 20 + " scumbag vilefool" * 120 if truth[i] else t, *r) for i, t, *r in rows]
    assert min(len(r[1]) for r in rows if truth[r[0]]) > 20_000
    lost = [(1000 + i, 1, 1) for i in range(3000)] + [(5000 + i, 1, 0) for i in range(3000)]
    docs = spark.createDataFrame(rows + [(1000 + i, None, "en", "s", 0) for i in range(1500)], SCHEMA)
    marks = spark.createDataFrame(labels + lost, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    assert model.weights is not None
    got = toxicity.score(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.95


def test_toxicity_warns_when_a_role_is_empty(spark):
    docs = spark.createDataFrame([(i, "some words", "en", "s", 1) for i in range(20)], SCHEMA)
    marks = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(90, 1, 1)], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning, match="no toxic labelled texts"):
        assert toxicity.train(docs, marks).weights is None


def test_non_negative_risk_is_corrected():
    """With as many weights as words and few texts the plain PU risk runs below zero; the corrected
    training must still rank the positives first."""
    rng = random.Random(2)
    clean = [" ".join(rng.choice(["aba", "cad", "efe", "gih", "olo"]) for _ in range(30)) for _ in range(60)]
    toxic = [c + " nasty nasty" for c in clean[:15]]
    texts = toxic + clean[15:30] + clean[30:] + [c + " nasty" for c in clean[:8]]
    roles = np.array([1] * 15 + [-1] * 15 + [0] * 38)
    m = toxicity.fit(texts, roles, 0.2)
    degree = toxicity.word_degrees(m.weights, ["nasty", "aba", "olo"])
    assert degree[0] > degree[1:].max()


def learning_sample(n_words, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(n_words)]
    texts = [" ".join(vocabulary[at:at + 100]) for at in range(0, n_words, 100)]
    return texts, np.array([rng.choice([toxicity.TOXIC, toxicity.UNLABELLED, toxicity.CLEAN]) for _ in texts])


def test_toxicity_learning_in_stretches_changes_no_weight(monkeypatch):
    texts, roles = learning_sample(3000)
    whole = toxicity.fit(texts, roles, 0.2, steps=4)
    monkeypatch.setattr(toxicity, "RUN_WORDS", 7)
    monkeypatch.setattr(toxicity, "RUN_ENTRIES", 101)
    short = toxicity.fit(texts, roles, 0.2, steps=4)
    assert whole.weights.any() and whole.weights.tobytes() == short.weights.tobytes()
    assert (whole.slope, whole.shift) == (short.slope, short.shift)


def test_toxicity_learning_holds_little_beside_its_features():
    """The learning task's arrays: 8 bytes a feature, and stretches of bounded size."""
    import tracemalloc
    texts, roles = learning_sample(60_000)
    n_features = 60_000 * (1 + 12 + 11 + 10)
    tracemalloc.start()
    toxicity.fit(texts, roles, 0.2, steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * n_features


# --- SentencePiece -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model_path):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model_path)


def random_texts(pieces):
    rng = random.Random(11)
    alphabets = ["ab", "etaoin shrdlu", "the THE ▁ \n\t.,;'\"", "aaaa bbb", "0123456789abcdef+/=", "²», m².com",
                 "éüñçß àèì日本語русский العربية😀\x00\x7f​﻿"]
    out = ["".join(rng.choice(a) for _ in range(rng.randint(1, 150))) for a in alphabets for _ in range(60)]
    out += ["".join(rng.choice(pieces) for _ in range(30)).replace("▁", rng.choice([" ", "▁", ""])) for _ in range(300)]
    out += [" " * k + x + " " * j for k in range(36) for j in (0, 1, 15, 16, 17) for x in ("", "a", "\n")]
    return out + ["x" * 5000, "ab" * 4000, " " * 3000, LONG[:20_000]]


def test_codec_equals_the_library(model_path, library):
    v = sentencepiece_bpe.Vocabulary.load(model_path)
    codec = sentencepiece_bpe.Codec(v)
    texts = random_texts([p for p in v.pieces if not p.startswith("<")])
    for text, raw in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(raw, "<i4").tolist()
        assert ids == library.encode(text), text[:80]
        assert codec.decode(ids) == library.decode(ids)
    rng = random.Random(5)
    for _ in range(500):        # any ids, broken byte runs too
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32_000)]) for _ in range(rng.randint(1, 20))]
        assert codec.decode(ids) == library.decode(ids)


def test_codec_reaches_workers_as_tables(model_path, library, monkeypatch):
    """Workers unpickle the tables instead of building them, and merge new words a bounded run at a time."""
    codec = pickle.loads(pickle.dumps(sentencepiece_bpe.Codec(sentencepiece_bpe.Vocabulary.load(model_path))))
    held = []
    encode_words = codec.encode_words
    monkeypatch.setattr(sentencepiece_bpe, "ROUND_CHARS", 300)
    monkeypatch.setattr(codec, "encode_words", lambda words: held.append(sum(map(len, words))) or encode_words(words))
    texts = [f"some {i} words, and {i * 7919} more of them" for i in range(400)]
    assert [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)] == library.encode(texts)
    assert len(held) > 5 and max(held) <= 300


def test_round_trip_column(spark, model_path, library):
    df = with_extra(spark.createDataFrame(odd_rows(), SCHEMA))
    tokenizer = sentencepiece_bpe.Tokenizer(spark, model_path)
    got = df.select("text", tokenizer.encode("text").alias("ids")).withColumn(
        "back", tokenizer.decode("ids")).collect()
    for r in got:
        assert r.ids == library.encode(r.text or "") and r.back == library.decode(r.ids)
    assert spark.createDataFrame([], SCHEMA).select(tokenizer.round_trip("text")).collect() == []


# --- independent versions of the learned models ----------------------------------------------------

def plain_kneser_ney(counted):
    """Nats of a word under interpolated Kneser-Ney over characters, with dictionaries only."""
    import math
    from collections import Counter, defaultdict
    order, discount = langid.ORDER, langid.DISCOUNT
    raw = [Counter() for _ in range(order + 1)]
    for word, times in counted.items():
        w = langid.HEAD + word + langid.TAIL
        for end in range(2, len(w) + 1):
            for n in range(1, min(order, end) + 1):
                raw[n][w[end - n:end]] += times
    amount = {order: raw[order]}
    for n in range(1, order):
        left = defaultdict(set)
        for g in raw[n + 1]:
            left[g[1:]].add(g)
        amount[n] = {g: raw[n][g] if n > 1 and g[0] == langid.HEAD else len(left[g]) for g in raw[n]}
    total, kinds = defaultdict(float), defaultdict(int)
    for n in range(1, order + 1):
        for g, c in amount[n].items():
            total[n, g[:-1]] += c
            kinds[n, g[:-1]] += c > 0

    def probability(g):
        n = len(g)
        if not n:
            return 1 / langid.ALPHABET
        held = total.get((n, g[:-1]), 0)
        if not held:
            return probability(g[1:])
        return max(amount[n].get(g, 0) - discount, 0) / held + discount * kinds[n, g[:-1]] / held * probability(g[1:])

    def cost(word):
        w = langid.HEAD + word + langid.TAIL
        return -sum(math.log(probability(w[max(0, end - order):end])) for end in range(2, len(w) + 1))

    return cost


def test_language_models_equal_plain_kneser_ney():
    from collections import Counter
    rng = random.Random(8)
    letters = ["abcdé ", "cdefgß ", "xyzabк "]
    corpora = [Counter("".join(rng.choice(x) for _ in range(700)).split()) for x in letters]
    model = langid.estimate(["l0", "l1", "l2"], [langid.count_grams(dict(c)) for c in corpora])
    plain = [plain_kneser_ney(c) for c in corpora]
    texts = ["".join(rng.choice("abcdéefgßxyzкq ") for _ in range(rng.randint(1, 60))) for _ in range(50)] + ["a", "ß", "qqqq"]
    for text in texts:
        items = text.split()
        want = [[cost(w) for cost in plain] + [len(w) + 1] for w in items]
        assert np.allclose(model.costs(items) if items else np.zeros((0, 4)), np.array(want).reshape(-1, 4), rtol=1e-9)
        sums = np.array(want).reshape(-1, 4).sum(axis=0)
        if items:
            names, score, entropy, _ = model.predict(sums[None, :])
            per = sums[:3] / sums[3]
            shares = np.exp(-(per - per.min()) * min(sums[3], langid.EVIDENCE))
            assert names == [f"l{per.argmin()}"] and entropy[0] == pytest.approx(per.min())
            assert score[0] == pytest.approx(1 / shares.sum())


@pytest.mark.parametrize("corrected", [False, True])
def test_first_step_follows_the_gradient_of_the_plain_risk(corrected):
    """Non-negative risk by loops over texts and words, its gradient by differences.  ``corrected``: the
    estimate of the clean risk is negative, so the step goes against it alone."""
    import math
    rng = random.Random(3)
    common, bad = ["red", "blue", "green", "house"], ["awful", "nasty"]
    positive = [" ".join(rng.choices(common + bad, k=6)) for _ in range(4)]
    unlabelled = ["" for _ in range(5)] if corrected else [" ".join(rng.choices(common, k=5)) for _ in range(5)]
    roles = np.array([toxicity.TOXIC] * 4 + [toxicity.UNLABELLED] * 5)
    prior = 0.6
    cells = {w: toxicity.features([w])[0].tolist() for w in common + bad}
    seen = {}
    for text in positive + unlabelled:
        for w in set(text.split()):
            for c in cells[w]:
                seen[c] = seen.get(c, 0) + 1

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def risk(moved):
        def g(text):
            ws = text.split()
            degrees = [sigmoid(toxicity.START + sum(moved.get(c, 0.0) for c in cells[w])) for w in ws]
            return -2.0 + toxicity.GAIN * (sum(degrees) / len(ws) if ws else 0.0)

        toxic_loss = sum(math.log1p(math.exp(-g(t))) for t in positive) / len(positive)
        clean = (sum(math.log1p(math.exp(g(t))) for t in unlabelled) / len(unlabelled)
                 - prior * sum(math.log1p(math.exp(g(t))) for t in positive) / len(positive))
        return -clean if clean < 0 else prior * toxic_loss + clean, clean

    assert (risk({})[1] < 0) == corrected
    weights = toxicity.fit(positive + unlabelled, roles, prior, steps=1).weights
    moved = 0
    for c in sorted({c for w in common + bad for c in cells[w]}):
        pace = (seen.get(c, 0) >= toxicity.RARE) / math.sqrt(seen.get(c, 0) + toxicity.SPREAD)
        slope = (risk({c: 1e-5})[0] - risk({c: -1e-5})[0]) / 2e-5
        want = max(-toxicity.LIMIT, min(toxicity.LIMIT, -toxicity.RATE * slope * pace ** 2))
        assert weights[c] == pytest.approx(want, abs=2e-4)
        moved += want != 0
    assert moved > 10


def test_langid_with_more_labels_than_it_learns(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["der", "die", "und"] if i % 2 else ["the", "and", "of"]) for _ in range(20)),
             "de" if i % 2 else "en", "s", 1) for i in range(60)]
    rows += [(1000 + i, "odd label text", f"label {i}", "s", 1) for i in range(langid.MAX_LANGUAGES + 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.warns(UserWarning, match="more than"):
        model = langid.train(df)
    assert len(model.languages) == langid.MAX_LANGUAGES and {"de", "en"} <= set(model.languages)
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert all(got[i] == ("de" if i % 2 else "en") for i in range(60)) and len(got) == len(rows)


def test_repeated_ids_are_learned_from_alike(spark):
    rows = [(i % 20, f"{'gut und' if i % 2 else 'good and'} word{'abcdefghij'[i % 7]}", "x" if i % 2 else "y", "s", 1) for i in range(200)]
    labels = [(i, i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    a, b = (langid.train(d) for d in (df, df.repartition(5, "text")))
    assert all(np.array_equal(x.values, y.values) for x, y in zip(a.logs, b.logs))
    a, b = (toxicity.train(d, marks) for d in (df, df.repartition(5, "text")))
    assert np.array_equal(a.weights, b.weights)
