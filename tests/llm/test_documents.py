"""Quality rules, near-duplicates, grades, secrets and repeats against brute force."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_tables import ordered, texts_of
from pyspark.sql import functions as F

from firmlens.llm import components, grades, near_dups, quality, queries, repeats, secrets

TABLES = ["odd", "documents", "nothing"]
BLANK = " \t\n\v\f\r"
SF = "/root/testdata/sf0.01"


def words_of(text: str) -> list[str]:
    out, word = [], ""
    for c in text + " ":
        if c in BLANK:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def base(text: str) -> tuple:
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if words_of(line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


@pytest.mark.parametrize("name", TABLES)
def test_quality_counts(request, name):
    table = request.getfixturevalue(name)
    rows = quality.quality_rules(table, quality.DEFAULT_FIELD).collect()
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert ordered(found) == ordered((k, *base(t or "")) for k, t in texts_of(table))
    assert all(r.kept == (not r.base_failed and r.content_share >= quality.CONTENT_SHARE) for r in rows)
    kept = quality.kept_documents(table, quality.DEFAULT_FIELD)
    assert kept.columns == table.columns
    assert ordered(r.doc_id for r in kept.collect()) == ordered(r.doc_id for r in rows if r.kept)


def test_viterbi_is_the_best_of_all_sequences():
    rng = np.random.default_rng(3)
    field = quality.LineField(rng.normal(size=(2, len(quality.FEATURES))), rng.normal(size=(2, 2)))
    for n in range(1, 9):
        x = rng.normal(size=(n, len(quality.FEATURES)))
        score = x @ field.emit.T

        def total(labels, score=score):
            return sum(score[i, y] for i, y in enumerate(labels)) + sum(field.move[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert field.labels(x).astype(int).tolist() == list(best)


def test_field_fit_separates_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.xxhash64("doc_id") % 3 == 0
    field = quality.fit_to_labels(docs, labels.filter(~held))
    rows = quality.quality_rules(docs, field).join(labels.filter(held), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_field_without_labels(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit_to_labels(odd, labels) is quality.DEFAULT_FIELD
    assert quality.fit_to_labels(nothing, spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], labels.schema)) is quality.DEFAULT_FIELD


@pytest.mark.parametrize("module", [quality, grades])
def test_fits_take_one_text_of_a_key(spark, module, monkeypatch):
    texts = [(1, f"good text number {i}\nwith a second line") for i in range(300)] + [(2, f"BUY ### {i} !!!") for i in range(3)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    given = []
    monkeypatch.setattr(module, "fit", lambda found, *_: given.append(len(found)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    if module is quality:
        quality.fit_to_labels(docs, labels)
    else:
        grades.fit_to_ratings(docs, labels, F.col("quality"), 2)
    assert given == [2]


def shingled(text: str, n: int) -> list[str]:
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def naive_simhash(text: str) -> int:
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingled(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(nodes: list, linked) -> dict:
    group = {n: n for n in nodes}

    def find(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = find(a), find(b)
            group[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("size", [2048, 2])
@pytest.mark.parametrize("name", TABLES)
def test_simhash_components(request, name, size, monkeypatch):
    monkeypatch.setattr(near_dups, "GROUP", size)
    table = request.getfixturevalue(name)
    prints = [(k, naive_simhash(t or "")) for k, t in texts_of(table)]
    group = grouped(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for k, p in prints:
        least[group[p]] += [k] if k is not None else []
    expected = [(k, f"{p:016x}", min(least[group[p]], default=None)) for k, p in prints]
    assert ordered(map(tuple, near_dups.simhash_components(table).collect())) == ordered(expected)


def test_links_join_close_fingerprints_of_any_kind(spark, monkeypatch):
    rng = np.random.default_rng(5)
    near = rng.integers(0, 1 << 62, 40)
    bits = {int(b) for b in near}
    for b in near:
        for _ in range(6):
            b = int(b)
            for p in rng.choice(64, rng.integers(1, 4), replace=False):
                b ^= 1 << int(p)
            bits.add(b)
    nodes = sorted(b - (1 << 64) if b >> 63 else b for b in bits)
    expected = grouped(nodes, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    for size in (2048, 3):
        monkeypatch.setattr(near_dups, "GROUP", size)
        links = near_dups.fingerprint_links(spark.createDataFrame([(n,) for n in nodes], "fingerprint long"))
        found = {r.node: r.component for r in components.components(links).collect()}
        assert {n: found.get(n, n) for n in nodes} == expected


def test_fuzzy_keys_meet_within_two_errors():
    """All remainders of the code, and all errors of at most two bits."""
    rest = near_dups.remainder(np.arange(1 << 23))
    one_of_each = np.unique(rest, return_index=True)[1]

    def keys(values):
        found = [set() for _ in values]
        for row, key in zip(*near_dups.fuzzy(values), strict=True):
            found[row].add(int(key))
        return found

    own = keys(one_of_each)
    assert {len(k) for k in own} == {1, 6}
    for a in range(23):
        for b in range(a, 23):
            other = keys(one_of_each ^ (1 << a | 1 << b))
            assert all(x & y for x, y in zip(own, other, strict=True))


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000), (1250, 1100), (3, 2)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


@pytest.mark.parametrize("name", TABLES)
def test_near_copies(request, name):
    table = request.getfixturevalue(name)
    rows = near_dups.without_copies(table)
    assert rows.columns == table.columns
    texts = sorted({(k, t or "") for k, t in texts_of(table)}, key=lambda r: (r[0] is not None, r[0] or 0))
    sets = [set(shingled(t, 5)) for _, t in texts]
    group = grouped(
        list(range(len(texts))),
        lambda a, b: sets[a] == sets[b] == set() or bool(sets[a] & sets[b]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]),
    )
    keys = [texts[i][0] for i in range(len(texts)) if group[i] == i]
    assert ordered(r.doc_id for r in rows.collect()) == ordered(keys)


def star(copies: int) -> list[tuple]:
    """Texts that are near the first but not near each other: each has words of its own at places of its own."""
    rng = np.random.default_rng(3)
    first = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    rows = [(0, " ".join(first))]
    for k in range(1, copies + 1):
        own = list(first)
        for i in rng.permutation(59)[:5]:
            own[5 * i + 2] = f"own{k}x{i}"
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("members", [1024, 300])
def test_near_copies_of_a_star(spark, members, monkeypatch):
    monkeypatch.setattr(near_dups, "MEMBERS", members)
    rows = star(1000)
    sets = [set(shingled(t, 5)) for _, t in rows]
    assert all(0.84 < len(sets[0] & s) / len(sets[0] | s) < 0.86 for s in sets[1:])
    assert np.mean([len(a & b) / len(a | b) < 0.8 for a, b in itertools.combinations(sets[1:60], 2)]) > 0.9
    kept = near_dups.without_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert [r.doc_id for r in kept.collect()] == [0]


def test_grades_of_held_out_documents(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held, grade = F.xxhash64("doc_id") % 4 == 0, 2 * F.col("quality") + 1 - F.col("toxic")
    grader = grades.fit_to_ratings(docs, labels.filter(~held), grade, 4)
    assert (np.diff(grader.thresholds) > 0).all() and (grader.weights <= 0).all()
    rows = grades.graded(docs, grader, 3).join(labels.filter(held).withColumn("grade", grade), "doc_id").collect()
    share = {g: np.mean([r.selected for r in rows if r.grade == g]) for g in range(4)}
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(4)]
    assert share[3] >= 0.97 and share[2] <= 0.15 and share[0] == share[1] == 0
    assert mean == sorted(mean)


def test_grades_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(5, 1), (11, 3), (17, 0), (1, 2), (None, 2), (6, None)], "doc_id long, grade int")
    grader = grades.fit_to_ratings(odd, labels, F.col("grade"), 4)
    rows = grades.graded(odd, grader, 2).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.expected_grade <= 3 and r.selected == (r.tail_probability >= 0.4) for r in rows)
    assert len({r.expected_grade for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert grades.graded(nothing, grader, 2).count() == 0
    blank = grades.fit_to_ratings(nothing, labels, F.col("grade"), 4)
    assert not blank.weights.any()


def naive_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in re.finditer("(?:%s)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)" % "|".join(
        "".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token", "api", "x")
    ).replace("[aA][pP][iI]|[xX]", "[aA][pP][iI]_?[kK][eE][yY]"), text):
        out += [("assign", *m.span())] if len(m[1]) >= 8 else []
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


@pytest.mark.parametrize("name", TABLES)
def test_secrets(request, name):
    table = request.getfixturevalue(name)
    rows = secrets.scan(table, queries.BYTE_RANKS).collect()
    found = [(r.doc_id, [tuple(s) for s in r.spans if s.kind != "random"]) for r in rows]
    assert ordered(found) == ordered((k, naive_spans(t or "")) for k, t in texts_of(table))
    if name == "odd":
        random = [(r.doc_id, s.end - s.start) for r in rows for s in r.spans if s.kind == "random"]
        assert random == [(20, 25)]
        clean = secrets.redact(table, queries.BYTE_RANKS)
        assert clean.columns == table.columns
        texts = {r.doc_id: r.text for r in clean.filter("doc_id in (19, 20)").collect()}
        assert texts[19] == '[SECRET]" and [SECRET] [SECRET]'
        assert texts[20].startswith("token=api:[SECRET]' [SECRET] [SECRET]")
        assert clean.filter("text is null").count() == table.filter("text is null").count()


def test_known_strings_are_not_random():
    encoding = secrets.vocabulary(queries.BYTE_RANKS)
    for known in ("D41D8CD98F00B204E9800998ECF8427E", "123e4567-e89b-12d3-a456-426614174000", "1234567890123456789012", "a" * 30, "internationalization_of_2024_programs"):
        assert not secrets.is_random(known, encoding, secrets.CHARS_PER_TOKEN)
    assert secrets.is_random("q7Zp0Xk2Lw9Rt4Vb8Nc3Ms6Hd", encoding, secrets.CHARS_PER_TOKEN)


def found_random(text: str) -> list[str]:
    spans = secrets.find(text, secrets.vocabulary(queries.BYTE_RANKS), secrets.CHARS_PER_TOKEN)
    return [text[a:b] for kind, a, b in spans if kind == "random"]


@pytest.mark.parametrize(("size", "least"), [(12, 0.75), (16, 0.9), (20, 0.97), (32, 0.99), (64, 0.99)])
@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])
def test_planted_random_strings_are_found(size, least, letters):
    rng = np.random.default_rng(size)
    least = {12: 0.5, 16: 0.7}.get(size, least) if "0" not in letters else least
    for around in ("see {} here", "https://example.com/download/documents/{}", "authorization={}", "file_name-{}/more-words"):
        values = ["".join(letters[i] for i in rng.integers(0, len(letters), size)) for _ in range(200)]
        hit = [any(v in s for s in found_random(around.format(v))) for v in values]
        assert np.mean(hit) >= least, around


def test_ordinary_text_is_not_random(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").filter("text is not null").select("text").collect()
    runs = [m[0] for r in texts for m in secrets.PART.finditer(r.text) if len(m[0]) >= 12]
    found = [s for r in texts for s in found_random(r.text)]
    assert len(runs) > 3_000 and len(found) <= 0.002 * len(runs)
    for known in ("getElementsByClassName(environmentVariables)", "src/main/java/org/example/internationalization/Test", "a/b/c/d/e/f/g/h/i/j/k/l/m/n",
                  "id=123e4567-e89b-12d3-a456-426614174000", "supercalifragilisticexpialidocious", "2024-01-02T03-04-05", "====================", "x_1_y_2_z_3_x_1_y_2_z_3"):
        assert found_random(known) == []


def removed(texts: list[tuple], window: int, keep_first: bool) -> list[tuple]:
    """Each row's sizes, spans and what is left."""
    data = [(t or "").encode() for _, t in texts]
    where = defaultdict(list)
    order = sorted(range(len(texts)), key=lambda i: (texts[i][0] is not None, texts[i][0] or 0))
    for i in order:
        for at in range(len(data[i]) - window + 1):
            where[data[i][at : at + window]].append((i, at))
    out = []
    for i, (key, _) in enumerate(texts):
        cover = np.zeros(len(data[i]), bool)
        for at in range(len(data[i]) - window + 1):
            found = where[data[i][at : at + window]]
            first = found[0]
            same = (first[1] == at) and texts[first[0]][0] == key and data[first[0]] == data[i]
            if (not same) if keep_first else len(found) > 1:
                cover[at : at + window] = True
        spans = int(np.diff(np.append(0, cover.astype(int))).clip(0).sum())
        left = np.frombuffer(data[i], np.uint8)[~cover].tobytes()
        out.append((key, len(data[i]), int(cover.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("size", [2048, 1])
@pytest.mark.parametrize("name", TABLES)
def test_repeats(request, name, size, keep_first, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", size)
    monkeypatch.setattr(repeats, "CHUNK", 3000)
    table = request.getfixturevalue(name)
    if keep_first and name == "odd":
        table = table.filter("not (doc_id <=> 4 and text != 'a')")  # the order of two texts of one key is a digest's
    rows = repeats.remove_repeats(table, 400, keep_first).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows]
    assert ordered(found) == ordered(removed(texts_of(table), 400, keep_first))


@pytest.mark.parametrize("key", [1, None])
def test_spans_of_repeated_rows_are_those_of_one_text(spark, key):
    text = " ".join(f"w{i * i}" for i in range(400))
    rows = 60 * [(key, text)] + [(2, "before " + text[:900]), (3, text[300:1500] + " after")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = table.select(F.col("doc_id").alias("k"), repeats.digest(F.col("text")).alias("digest"), "text")
    found = repeats.repeated_spans(docs, 400, False, "bigint").collect()
    assert len(found) == 3 and all(len(r.spans) == len(set(r.spans)) <= len(text) for r in found)
    rows_left = repeats.remove_repeats(table, 400, False).collect()
    left = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows_left]
    assert ordered(left) == ordered(removed(rows, 400, False))


def test_texts_without_repeats_keep_whole_characters(odd):
    table = repeats.without_repeats(odd, 100)
    assert table.columns == odd.columns
    rows = texts_of(table)
    assert len(rows) == odd.count() and sum(t is None for _, t in rows) == 2
    assert all(len(t or "") <= 1_600 for k, t in rows if k in (13, 14, 15))
    before = dict(texts_of(odd.filter("doc_id = 11")))
    assert dict(rows)[11] == before[11]


def common_prefix(a: bytes, b: bytes, most: int) -> int:
    return next((i for i in range(most) if a[i : i + 1] != b[i : i + 1]), most)


@pytest.mark.parametrize("window", [8, 13, 16, 50])
def test_previous_factors(window):
    rng = np.random.default_rng(window)
    for letters, size in ((2, 60), (2, 300), (26, 200), (1, 120), (256, 90)):
        data = rng.integers(0, letters, size).astype(np.uint8)
        data[size // 2 : size // 2 + 40] = data[5:45][: len(data[size // 2 : size // 2 + 40])]
        places = np.flatnonzero(rng.random(size - window + 1) < 0.8)
        text = data.tobytes()
        suffixes = repeats.suffix_array(data, places, window)
        strings = [text[p : p + window] for p in places]
        order = sorted(range(len(places)), key=lambda i: (strings[i], i))
        assert suffixes.order.tolist() == order
        assert suffixes.common.tolist() == [0] + [common_prefix(strings[a], strings[b], window) for a, b in itertools.pairwise(order)]
        factor, earlier = repeats.longest_previous(suffixes)
        for i, own in enumerate(strings):
            known = [common_prefix(own, s, window) for s in strings[:i]]
            assert factor[i] == max(known, default=0)
            assert (earlier[i] < i and known[earlier[i]] == factor[i]) if factor[i] else earlier[i] < i


def test_no_and_one_suffix():
    for n in (0, 1):
        factor, earlier = repeats.longest_previous(repeats.suffix_array(np.arange(n + 7, dtype=np.uint8), np.arange(n), 8))
        assert factor.tolist() == [0] * n and earlier.tolist() == [-1] * n


def test_texts_of_one_key_with_equal_short_hashes(spark):
    family = spark.range(200_000).select("id", F.concat(F.lit(" ".join(f"word{i * i}" for i in range(70))), F.lit(" number "), "id").alias("text"))
    other = spark.range(200_000).select("id", F.concat(F.lit(" ".join(f"other{i * i}" for i in range(66))), F.lit(" number "), "id").alias("text"))
    one, two = (t.select(F.hash("text").alias("h"), F.col("text").alias(name)) for t, name in ((family, "a"), (other, "b")))
    pair = one.join(two, "h").select("a", "b").first()
    assert pair is not None and pair.a != pair.b
    docs = spark.createDataFrame([(None, pair.a), (None, pair.b), (1, pair.a)], "doc_id long, text string")
    rows = {(r.doc_id, r.n_bytes): r.n_removed for r in repeats.remove_repeats(docs, 400, False).collect()}
    assert rows == {(None, len(pair.a)): len(pair.a), (None, len(pair.b)): 0, (1, len(pair.a)): len(pair.a)}
    kept = sorted((r.doc_id or 0, r.text) for r in repeats.without_repeats(docs, 400).collect())
    assert kept == sorted([(0, pair.a), (0, pair.b), (1, "")])


@pytest.mark.parametrize("name", TABLES)
def test_one_document_of_each_simhash_component_stays(request, name):
    table = request.getfixturevalue(name)
    kept = near_dups.without_simhash_copies(table)
    assert kept.columns == table.columns
    rows = kept.select("doc_id", "text").collect()
    prints = {(k, t): naive_simhash(t or "") for k, t in texts_of(table)}
    group = grouped(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least: dict = {}
    for (k, t), bits in prints.items():
        place = (k is not None, k or 0)
        least[group[bits]] = min(least.get(group[bits], place), place)
    got = {group[prints[r.doc_id, r.text]]: (r.doc_id is not None, r.doc_id or 0) for r in rows}
    assert len(rows) == len(got) and got == least
