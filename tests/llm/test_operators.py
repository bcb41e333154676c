"""The training-data operators against brute force, and at their edges."""

import itertools
import math
import random
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pumpguard.llm import (common, decontaminate, html_extract, license_scan, lm_score, packing,
                           quality_rules, sharding, simhash, toxicity, warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, row string, n int"
WORDS = "sun moon star sky rain wind snow fog hail ice sea lake hill rock sand tree leaf root".split()


def sentence(seed, n=80):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and blank, long, repeated rows, tied ids, clashing names."""
    rows = [(1, "", "en", "a", 0, 1, "x", 1), (2, None, None, None, None, None, None, None),
            (None, "one two three", "en", "a", 13, 2, "y", 2), (3, " \n\t ", "en", "b", 4, 3, "z", 3),
            (4, sentence(1, 30_000), "en", "a", 9, 4, "x", 4), (5, sentence(2), "en", None, 1, 5, "", 5),
            (5, sentence(2), "en", None, 1, 5, "", 5), (5, sentence(3), "de", "b", 1, 5, "", 5),
            (None, None, None, None, None, None, None, None), (6, "É Ünï <|endoftext|> 日本", "fr", "c", 1, 6, "", 6)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 0), (None, 1, 1), (5, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, sentence(2, 20)), (1, "two words"), (2, None), (3, ""), (None, "one two three")],
                                 "item_id long, text string")


def whole(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name,columns,run", [
    ("license", 1, lambda d, l, i: license_scan.scan(d)), ("shard", 1, lambda d, l, i: sharding.interleave(d)),
    ("pack", 1, lambda d, l, i: packing.pack(d)), ("quality", 1, lambda d, l, i: quality_rules.verdicts(d, l)),
    ("toxicity", 1, lambda d, l, i: toxicity.score(d, l)), ("lm", 1, lambda d, l, i: lm_score.score(d, l)),
    ("simhash", 1, lambda d, l, i: simhash.near_duplicates(d)),
    ("decontaminate", 0, lambda d, l, i: decontaminate.contaminated(d, i))])
def test_odd_and_empty_tables(spark, odd, labels, items, name, columns, run):
    got = run(odd, labels, items)
    if name == "pack":
        assert got.filter("piece = 0").count() == odd.count()
    elif columns:
        assert got.count() == odd.count()
    assert run(odd.filter("false"), labels, items).count() == 0
    assert run(odd, labels.filter("false"), items.filter("false")).count() >= 0
    if "doc_id" in got.columns and columns:
        assert {r[0] for r in got.select("doc_id").collect()} == {1, 2, 3, 4, 5, 6, None}


def test_pipeline_stages_on_odd_tables(spark, odd, tmp_path):
    import corpus_pipeline as P
    sf = str(tmp_path)
    odd.write.parquet(f"{sf}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    for docs in (odd, odd.filter("false")):
        for name, stage in P.STAGES:
            docs = common.written(stage(spark, docs, sf), "t")
            assert name == P.STAGES[-1][0] or docs.columns == odd.columns
        rows = docs.count()
    assert rows == 0
    assert P.run(spark, sf).count() >= 0


def test_words_match_their_pattern():
    r = random.Random(3)
    for _ in range(500):
        t = "".join(r.choice("aZ9_ -'.,\n\x1c\x85\xa0ªµÀé×ß—⁠⁰日😀") for _ in range(20)).lower()
        assert [w.encode() for w in common.WORD.findall(t)] == common.byte_words(t)


def test_components_of_random_graphs(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    edges += [(500, 500 + i) for i in range(1, 50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in common.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


# ------------------------------------------------------------------ licences

def test_every_known_sentence_has_a_cue_and_is_normal():
    for s in license_scan.SENTENCES.values():
        assert re.search(license_scan.CUE, s) or "rights reserved" in s, s
        assert s == re.sub("[^a-z0-9]+", " ", s.lower()).strip()
    named = {i for _, _, ids in license_scan.RULES for i in ids}
    assert named - {"copyright"} <= set(license_scan.SENTENCES)


def test_license_rules(spark):
    mit = (" * Permission is hereby granted, free of charge, to any person obtaining a copy of this\n * software "
           "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
           "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
           "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
           "included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", "
           "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
           "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
    texts = {1: mit, 2: "x\nLicensed under CC BY-NC 4.0.\ny", 3: "Copyright (c) 2020 2021 A. B.\nAll rights reserved.",
             4: "This licensed plumber came.", 5: "Released under the MIT License. Licensed under CC BY 4.0."}
    got = {r["doc_id"]: (r["rule"], r["licenses"]) for r in license_scan.scan(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {1: ("mit_text", "MIT"), 2: ("cc_by_nc", "CC-BY-NC-4.0"), 3: ("proprietary", "All-Rights-Reserved"),
                   4: (None, ""), 5: ("mit_released", "MIT,CC-BY-4.0")}


GPL = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General "
       "Public License as published by the Free Software Foundation{1} either version {2} of the License, or (at your "
       "option) any later version.")
HOPE = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License "
        "for more details.")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
       "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")


def licences(spark, texts):
    return {r["doc_id"]: (r["rule"], r["licenses"]) for r in license_scan.scan(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}


def test_official_notices(spark):
    wrapped = [textwrap.fill(t, 70) for t in (GPL.format(":", ",", 3), GPL.format(";", ";", 2), HOPE, MPL)]
    gpl3, gpl2, hope, mpl = wrapped
    mixed = gpl2 + "\n\n" + GPL.format(",", "", 9) + "\n\neither version 3 of the License, or (at your option) any later version."
    got = licences(spark, {1: gpl3 + "\n\n" + hope, 2: gpl2 + "\n\n" + hope, 3: gpl3, 4: gpl2, 5: mpl, 6: mixed,
                           7: gpl3.replace("This program", "Foobar") + "\n\n" + hope.replace("This program", "Foobar")})
    assert got == {1: ("gpl3_header", "GPL-3.0-or-later"), 2: ("gpl2_header", "GPL-2.0-or-later"),
                   3: ("gpl3_free", "GPL-3.0-or-later"), 4: ("gpl2_free", "GPL-2.0-or-later"),
                   5: ("mpl_header", "MPL-2.0"), 6: ("gpl2_free", "GPL-2.0-or-later"), 7: ("gpl3_header", "GPL-3.0-or-later")}


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
       "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
       "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
       "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
       "of the Software.",
       "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
       "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
       "granted, provided that the above copyright notice and this permission notice appear in all copies.",)
BSD2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD3 = BSD2 + ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
               "promote products derived from this software without specific prior written permission.",)
APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
          "compliance with the License. You may obtain a copy of the License at",
          "    http://www.apache.org/licenses/LICENSE-2.0",
          "Unless required by applicable law or agreed to in writing, software distributed under the License is "
          "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
          "See the License for the specific language governing permissions and limitations under the License.")


@pytest.mark.parametrize("mark,first,last", [("//", "", ""), ("#", "#!/bin/sh\n#\n", ""), (" *", "/*\n", " */\n"),
                                             (" *", "/**\n", " **/\n"), ("--", "", ""), ("", "", "")])
def test_licences_in_comments_after_a_copyright_line(spark, mark, first, last):
    want = {"mit_text": ("MIT", MIT), "isc_text": ("ISC", ISC), "bsd2_text": ("BSD-2-Clause", BSD2),
            "bsd3_text": ("BSD-3-Clause", BSD3), "apache_header": ("Apache-2.0", APACHE),
            "gpl3_header": ("GPL-3.0-or-later", (GPL.format(":", ",", 3), HOPE)),
            "gpl2_header": ("GPL-2.0-or-later", (GPL.format(";", ";", 2), HOPE)), "mpl_header": ("MPL-2.0", (MPL,))}
    texts = {}
    for k, (_, parts) in enumerate(want.values()):
        text = "\n\n".join(textwrap.fill(p, 66) for p in ("Copyright (c) 2020 Jane Doe", *parts))
        texts[k] = first + "".join(f"{mark} {x}".rstrip() + "\n" for x in text.split("\n")) + last + "int main() {}\n"
    got = {k: (rule, names.split(",")[0]) for k, (rule, names) in licences(spark, texts).items()}
    assert got == {k: (rule, name) for k, (rule, (name, _)) in enumerate(want.items())}


def test_usual_wordings_of_short_notices(spark):
    library = GPL.replace("program", "library").replace("GNU General", "GNU Lesser General")
    affero = (GPL + "\n\n" + HOPE).replace("GNU General", "GNU Affero General")
    got = licences(spark, {
        1: "This project is licensed under the MIT License.", 2: "The source code is released under the MIT license.",
        3: "This software is licensed under the terms of the GNU Affero General Public License, version 3.",
        4: library.format(";", ";", "2.1") + " " + HOPE.replace("GNU General", "GNU Lesser General"),
        5: affero.format(":", ",", 3), 6: library.format(":", ",", 3), 7: "My cat is licensed under the MIT License.",
        8: "This work is licensed under CC BY-SA 4.0.",
        9: "This work is licensed under the GNU General Public License version 3."})
    assert got == {1: ("mit_licensed", "MIT"), 2: ("mit_released", "MIT"), 3: ("agpl_licensed", "AGPL-3.0-only"),
                   4: ("lgpl2_1_header", "LGPL-2.1-or-later"), 5: ("agpl3_header", "AGPL-3.0-or-later"),
                   6: ("lgpl3_free", "LGPL-3.0-or-later"), 7: (None, ""), 8: ("cc_by_sa", "CC-BY-SA-4.0"),
                   9: ("gpl3_work", "GPL-3.0-only")}
    assert len(set(license_scan.SENTENCES.values())) == len(license_scan.SENTENCES)


# ------------------------------------------------------------------ shards

def test_shards_are_even_and_hold_the_mixture(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 else f"s{i % 21}") for i in range(4003)]
    got = sharding.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert sorted(by) == list(range(40)) and {len(v) for v in by.values()} == {100, 101}
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
        assert abs(sum(r["stratum"] == "hot" for r in v) - len(v) * 2 / 3) < 6
    again = sharding.interleave(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(5))
    assert whole(again) == sorted((tuple(r) for r in got), key=repr)


def test_rank_splits_a_hot_group(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").alias("k"),
                                  common.unit_hash("x", F.col("id")).alias("u"))
    for r in common.rank_by_unit(df, ["k"], "u", ["id"], 7, "rank").groupBy("k").agg(
            F.count("*").alias("n"), F.max("rank").alias("top"), F.countDistinct("rank").alias("d")).collect():
        assert r["n"] == r["d"] == r["top"] + 1


# ------------------------------------------------------------------ packing

def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer_path())
    words = packing.WordIds(t)
    texts = ["", "don't 'S !!'s", "İ ſ ª ß ÷×", "a\x85b\xa0c\x1cd", "x<|endoftext|>y", "日本 é", "2½²"]
    texts += [chr(c) + "a" + chr(c) * 2 + " " + chr(c) for c in range(1, 0x250)] + [sentence(i) for i in range(20)]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert packing.token_bytes(x, words) == b"".join(i.to_bytes(4, "little") for i in ids), repr(x)


def test_plain_words_are_learned_from_their_pieces_by_a_bare_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer_path())
    words = packing.WordIds(t)
    words.tokenizer = None  # the whole tokenizer is not asked for plain texts
    for x in ("Don't \xa0stop, don't (stop) 12½!", "stop, 1", "''s x\t\n"):
        ids = t.encode(x, add_special_tokens=False).ids
        assert packing.token_bytes(x, words) == b"".join(i.to_bytes(4, "little") for i in ids)
    assert {"don't", "don", "'t", "stop", "stop,", ","} <= set(words)


@pytest.mark.parametrize("seed", range(8))
def test_plan_fills_sequences_without_gaps(seed):
    r = random.Random(seed)
    cap = r.choice([5, 17, 64])
    counts = {n: r.randint(1, 50) for n in r.sample(range(1, cap + 1), r.randint(1, cap))}
    filled = {}
    for length, lo, hi, first, per, base in packing.plan(counts, cap):
        for k in range(hi - lo):
            filled.setdefault(first + k // per, []).append((base + k % per * length, length))
    assert Counter(n for f in filled.values() for _, n in f) == Counter(counts)
    for f in filled.values():
        f.sort()
        assert [o for o, _ in f] == [sum(n for _, n in f[:k]) for k in range(len(f))]
        assert sum(n for _, n in f) <= cap
    assert len(filled) == _best_fit_decreasing(counts, cap)


def _best_fit_decreasing(counts, cap):
    rooms = []
    for n in sorted(Counter(counts).elements(), reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(cap - n)
    return len(rooms)


def test_packed_pieces_cover_their_documents(spark, odd):
    rows = packing.pack(odd, capacity=512).collect()
    long = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == 4)
    assert all(s == 512 * p and (n == 512 or p == len(long) - 1) for p, s, n in long)
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in by.values():
        v.sort()
        assert [o for o, _ in v] == [sum(n for _, n in v[:k]) for k in range(len(v))] and sum(n for _, n in v) <= 512


# ------------------------------------------------------------------ quality

def _statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered))


@pytest.mark.parametrize("bits", [24, 3])   # 3: texts have more windows than places
def test_statistics_match_brute_force(spark, odd, monkeypatch, bits):
    monkeypatch.setattr(quality_rules, "PLACE_BITS", bits)
    extra = ["a b c a b c", "a a a a", "a b c d", "x\nx\n \n \nx", "a b", "é|é #é", "a b c x a b c y a b c"]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(extra, 100)), "doc_id long, text string"))
    docs = docs.union(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    want = Counter((r["doc_id"], *_statistics(r["text"])) for r in docs.collect())
    got = quality_rules.statistics(docs).select("doc_id", *quality_rules.STATS).collect()
    assert Counter(tuple(r) for r in got) == want


def test_rules_are_learned_and_applied(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules.verdicts(docs, labels).join(labels, "doc_id").filter("not base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) == 0 and counts[(0, False)] > 10 * counts.get((0, True), 0)


# ------------------------------------------------------------------ toxicity

def test_marginals_equal_enumeration():
    field = toxicity.Field(-1.3, [[0.4, -0.7], [-0.2, 0.9]], {"w=bad": 2.1, "b=nast": 1.4, "w=hm": -0.5})
    words = "so bad it hm nasty nastier day bad".split()
    total, marks = 0.0, [0.0] * len(words)
    for path in itertools.product((0, 1), repeat=len(words)):
        s = sum((field.bias + (field.emission(w) or 0.0)) * y for w, y in zip(words, path))
        s += sum(field.moves[a][b] for a, b in zip(path, path[1:]))
        e = 2.718281828459045 ** s
        total += e
        marks = [m + e * y for m, y in zip(marks, path)]
    places = [i for i, w in enumerate(words) if field.emission(w) is not None]
    got = field.marginals(places, [field.emission(words[i]) for i in places], len(words))
    assert got == pytest.approx([marks[i] / total for i in places])
    assert toxicity.tag(" ".join(words), field, 0.5)[1] == [
        (m.start(), m.end()) for i, m in enumerate(re.finditer(r"\w+", " ".join(words)))
        if i in places and marks[i] / total >= 0.5]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500
    assert sum(r["toxic"] == r["predicted"] for r in rows) >= 0.98 * len(rows)
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.005 * len(clean)


def test_a_toxic_word_in_a_fixed_phrase_is_learned_and_copied_texts_are_not(spark):
    r = random.Random(11)

    def text(*middle):
        words = [r.choice(WORDS) + str(r.randrange(40)) for _ in range(60)]
        return " ".join([*words[:30], *middle, *words[30:]])
    copy = text(*(f"copied{c * 3}" for c in "abcdefghij")).split()
    rows = [(i, text("you", "utter", "grubnazz") if i < 120 else text(), int(i < 200)) for i in range(600)]
    rows = [(i, " ".join(w if r.random() > 0.02 else "ash" for w in copy), 1) if 120 <= i < 200 else (i, t, x)
            for i, t, x in rows]
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id long, quality int, toxic int")
    field = toxicity.fit(docs, labels)
    assert "w=grubnazz" in field.weights and not any("copied" in f or f == "b=copi" for f in field.weights)
    scored = {d["doc_id"]: d["predicted"] for d in toxicity.score(docs, labels).collect()}
    assert all(scored[i] == 1 for i in range(120)) and not any(scored[i] for i in range(200, 600))


# ------------------------------------------------------------------ language model

def test_target_texts_score_lower(spark):
    docs = [(i, sentence(i, 60) if i % 2 else "ash oak " * 30) for i in range(40)] + [(99, "")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in lm_score.score(spark.createDataFrame(docs, "doc_id long, text string"),
                                                  labels, frequent_words=64).collect()}
    assert max(got[i]["score"] for i in range(1, 40, 2)) < min(got[i]["score"] for i in range(0, 40, 2))
    assert got[99]["score"] is None and got[99]["in_target"] is False


def test_all_words_score_as_counted_by_hand(spark, odd, labels, monkeypatch):
    """Also past 2,046 words, with hot words and bigrams and without."""
    r = random.Random(5)
    texts = {i: " ".join(f"{'ab'[i % 2]}{r.randrange(1500)}" if k % 3 else "The" for k in range(120)) for i in range(60)}
    texts |= {60: "", 61: None, 62: " \n", 63: "a1 b1 a1 b1"}
    docs = spark.createDataFrame([*texts.items(), (3, texts[3]), (None, texts[4])], "doc_id long, text string")
    told = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    rows = [(d["doc_id"], (d["text"] or "").encode().lower().split()) for d in docs.collect()]
    pairs, contexts, single = ([Counter(), Counter()] for _ in range(3))
    for doc, words in rows:
        for m in (0, 1) if doc in range(1, 30, 2) else (0,):
            pairs[m].update(zip([b"", *words], words))
            contexts[m].update([b"", *words][:-1])
            single[m].update(words)
    assert len(single[0]) > lm_score.FREQUENT - 1

    def log(m, u, v):
        alone = (single[m][v] + 1) / (sum(single[m].values()) + len(single[0]) + 1)
        return math.log(0.75 * pairs[m][u, v] / contexts[m][u] + 0.25 * alone if contexts[m][u] else alone)
    want = {(doc, len(words)): sum(log(0, u, v) - log(1, u, v) for u, v in zip([b"", *words], words)) / len(words)
            if words else None for doc, words in rows}
    for share in (lm_score.HOT_SHARE, 0.003, 1.0):
        monkeypatch.setattr(lm_score, "HOT_SHARE", share)
        got = lm_score.score_all_words(docs, told).collect()
        assert sorted((g["doc_id"] is None, g["doc_id"] or 0, g["n_tokens"]) for g in got) == sorted(
            (d is None, d or 0, len(w)) for d, w in rows)
        for g in got:
            value = want[g["doc_id"], g["n_tokens"]]
            assert g["score"] == (None if value is None else pytest.approx(value, abs=2e-6))
            assert g["in_target"] == (value is not None and g["score"] < 0)
    assert lm_score.score_all_words(odd, labels).count() == odd.count()
    assert lm_score.score_all_words(odd.filter("false"), labels).count() == 0


# ------------------------------------------------------------------ simhash

def _print(text):
    import xxhash
    words = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(prints, bits):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(list(root), 2):
        if bin(a ^ b).count("1") <= bits:
            root[find(a)] = find(b)
    return {p: find(p) for p in root}


@pytest.mark.parametrize("max_list,bits", [(1024, 4), (2, 4), (2, 3)])
def test_links_join_what_all_pairs_join(spark, max_list, bits):
    r = random.Random(bits)
    base = [r.getrandbits(64) for _ in range(15)]
    prints = {0, *base, *(b ^ sum(1 << k for k in r.sample(range(64), r.randrange(1, 6)))
                          for b in base for _ in range(12))}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), bits, max_list)
    roots = {x["node"] % (1 << 64): x["root"] % (1 << 64) for x in common.components(edges).collect()}
    want = _classes(prints, bits)
    got = {p: roots.get(p, p) for p in prints}
    group = lambda c: {frozenset(p for p in prints if c[p] == k) for k in set(c.values())}
    assert group(got) == group(want)


def test_triples_cover_any_four_positions():
    triples = simhash.covering_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(q) for t in triples) for q in itertools.combinations(range(8), 4))


def test_near_duplicates_match_brute_force(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select(
        F.col("doc_id") + 1000, "text"))
    rows = docs.collect()
    prints = [_print(r["text"]) for r in rows]
    cls = _classes(set(prints), 4)
    low = {}
    for r, p in zip(rows, prints):
        if r["doc_id"] is not None:
            low[cls[p]] = min(low.get(cls[p], r["doc_id"]), r["doc_id"])
    want = Counter((r["doc_id"], f"{p:016x}", low.get(cls[p])) for r, p in zip(rows, prints))
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(tuple(r) for r in got) == want
    kept = simhash.one_of_each(docs).collect()
    assert len(kept) == len(set(cls.values())) and len({cls[_print(r["text"])] for r in kept}) == len(kept)


# ------------------------------------------------------------------ archive

def test_archive_rebuilds_exact_records(spark, scratch):
    import hashlib
    body = "é" * 80
    rows = [(3, "http://a/", body), (1, "http://b/", body), (2, None, "small"), (4, "x", "small"), (5, "u", None),
            (None, "n\r\nX: y", body), (1, "http://b/", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archive(pages, scratch)
    got = warc.read_archive(spark, scratch).collect()
    assert len(got) == len(rows) and spark.read.parquet(f"{scratch}/payloads").count() == 3
    assert len({r["record_id"] for r in got}) == len(rows)
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter([(1, "response", None), (1, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1),
                             (2, "response", None), (4, "response", None), (5, "response", None)])
    for r in got:
        payload = bytes(r["payload"])
        assert r["payload_digest"] == hashlib.sha256(payload).hexdigest() and r["payload_bytes"] == len(payload)
        head = bytes(r["header"]).decode()
        assert head.startswith("WARC/1.1\r\n") and head.endswith("\r\n\r\n")
        assert f"Content-Length: {len(bytes(r['body']))}\r\n" in head and head.count("\r\n\r\n") == 1
    assert warc.archive_round_trip(pages.filter("false")).count() == 0


def test_a_damaged_payload_is_noticed(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string")
    warc.write_archive(pages, scratch)
    stored = spark.read.parquet(f"{scratch}/payloads").withColumn("payload", F.lit(b"y" * 200)).collect()
    spark.createDataFrame(stored).write.mode("overwrite").parquet(f"{scratch}/payloads")
    with pytest.raises(Exception, match="damaged record"):
        warc.read_archive(spark, scratch).collect()


# ------------------------------------------------------------------ pages

def test_tree_marginals_equal_enumeration():
    parents, own, edge = [-1, 0, 0, 1, 1, 2], [0.3, -1.0, 2.0, 0.7, -0.4, 1.1], [[0.2, -0.5], [0.1, 0.9]]
    total, marks = 0.0, [0.0] * 6
    for path in itertools.product((0, 1), repeat=6):
        s = sum(o * y for o, y in zip(own, path)) + sum(edge[path[p]][path[i]] for i, p in enumerate(parents) if i)
        total += 2.718281828459045 ** s
        marks = [m + 2.718281828459045 ** s * y for m, y in zip(marks, path)]
    got, _ = html_extract.marginals(parents, own, edge)
    assert got == pytest.approx([m / total for m in marks])


def test_pages_give_their_article(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        plain = re.sub(r"</?(?:b|a)\b[^>]*>", "", article)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", plain)).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_unusual_pages(spark):
    text = "A sentence that is long enough to look like the text of an article, with an end. " * 3
    pages = {
        1: f"<body><div class='menu'><a href=x>Home</a></div><div class=content><p>{text}<p>Second &lt;b&gt; "
           f"<i>p</i>art &amp; more, a full sentence too.</div><div id=comments><p>{text}</div><footer>(c)</footer>",
        2: None, 3: "", 4: "no markup at all", 5: "<p>unclosed <b>bold", 6: "<script>var p='<p>x</p>'</script>",
        7: "<<<>>><p", 8: "<article><aside><p>ad</aside><form><p>fill in</form><p>Only\n\tthis.&nbsp;</p></article>",
        9: "<!-- <p>c</p> --><article><style>p{}</style><h1>T</h1>x<br>y</article><nav>n</nav>" + "<div>" * 3000}
    df = spark.createDataFrame([(k, None, v) for k, v in pages.items()], "page_id long, url string, html string")
    df = df.union(spark.read.parquet(f"{SF}/pages.parquet").select(F.col("page_id") + 1000, "url", "html"))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).filter("page_id < 1000").collect()}
    assert got[1] == " ".join(text.split()) + " Second <b> part & more, a full sentence too."
    assert got[2] == got[3] == got[6] == "" and got[8] == "Only this." and got[9] == "T x y"
    assert html_extract.extract(df.filter("false")).count() == 0


@pytest.mark.parametrize("before,after", [
    ('<body class="has-sidebar"><div><p>', "</p></div>"), ('<body class="has-sidebar search"><article><p>', "</p></article>"),
    ('<body class="has-sidebar"><div id="content" class="comments-open"><p>', "</p></div>"),
    ('<div class="wrapper with-sidebar"><div><p>', "</p></div></div>"),
    ('<div class="wrapper sidebar"><article><p>', "</p></article></div>"),
    ('<form><main><div><p>', "</p></div></main></form>"), ('<article class="post tag-search"><p>', "</p></article>"),
    ('<article class="tag-search"><p>', "</p></article>"), ('<main class="main search"><p>', "</p></main>")])
def test_names_of_wrappers_do_not_lose_the_main_text(before, after):
    main = "A main text that is long enough to be one, with several words in it and an end to its sentence."
    aside = "Someone has left a reply here that is long enough too, and it also has an end to its sentence."
    parts = "".join(p % aside for p in ('<div class="main-nav"><p>%s</p></div>', '<div class="comments post"><div class="comments">'
                                        '<p>%s</p></div></div>', '<article class="comment"><p>%s</p></article>',
                                        '<section class="comments"><p>%s</p></section>',
                                        '<div hidden><article><p>%s</p></article></div>'))
    html = before + main + after + parts
    assert html_extract.content(html, html_extract.PRIOR, html_extract.PRIOR_EDGE) == main
    page = html_extract.Page(html)
    labels = html_extract.markup_labels(page)
    if "<article" in before or "<main" in before:
        assert [labels[block] for block, _, _ in page.pieces] == [1, 0, 0, 0, 0, 0]
    inside = "<main><p>" + main + '</p><section class="comments"><article><p>' + aside + "</p></article></section></main>"
    assert html_extract.content(inside, html_extract.PRIOR, html_extract.PRIOR_EDGE) == main


# ------------------------------------------------------------------ decontamination

def _align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_matches_the_full_table():
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.choice("abcd") for _ in range(r.randrange(1, 12))] for _ in range(2))
        score, start, stop = decontaminate.align(a, b)
        assert score == _align(a, b) == (_align(a, b[start:stop]) if score else 0)


def test_copies_and_edited_copies_are_found(spark):
    item = [f"term{i % 37}x{i}" for i in range(40)]
    edited = [w for i, w in enumerate(item) if i % 9] + ["tail"]
    edited[5] = "other"
    docs = {1: sentence(1) + " " + " ".join(item).upper() + ". " + sentence(2), 2: sentence(3),
            3: sentence(4) + " " + ", ".join(edited) + " " + sentence(5), 4: " ".join(item[:8]) + " " + sentence(6),
            5: " ".join(item)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "quite unrelated words stand here")], "item_id long, text string")
    for block_bytes in (4_000_000, 10):
        got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(df, bench, block_bytes=block_bytes).collect()}
        assert set(got) == {(1, 7), (3, 7), (5, 7)}
        hit = got[1, 7]
        assert docs[1][hit["start"]:hit["stop"]] == " ".join(item).upper() and hit["score"] == 1.0
        left = decontaminate.without_contaminated(df, bench, block_bytes=block_bytes)
        assert {r["doc_id"] for r in left.collect()} == {2, 4}


def test_decontamination_matches_aligning_everything(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(12).collect()
    texts = [(r["doc_id"], " ".join(decontaminate.words_of(r["text"])[k].decode() for k in range(min(
        120, len(decontaminate.words_of(r["text"])))))) for r in docs]
    texts += [(10_000 + i, texts[i][1] + " " + r["text"]) for i, r in enumerate(items)]
    want = {(d, r["item_id"]) for d, t in texts for r in items
            if _align(decontaminate.words_of(r["text"]), decontaminate.words_of(t))
            >= decontaminate.LIMIT * decontaminate.MATCH * len(decontaminate.words_of(r["text"]))}
    got = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) >= 12
