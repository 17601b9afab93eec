"""Toxicity, cross-tokenizer alignment and the Merkle manifest against plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from beaconlake.llm import crosstoken, merkle, queries, sanitise, toxicity
from beaconlake.llm.common import prepared
from beaconlake.llm.crosstoken import VOCABULARY_A, VOCABULARY_B

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n", "a  b", "<|endoftext|> <s> </s> <unk>", "<0x41>", "▁x", "ﬁ ligature", "é😀\t\x00q", " lead", "tail ", "x" * 5000, "²½", "ab\n\ncd  \n e"]


# -- Merkle manifest


def field(value):
    text = None if value is None else str(value)
    return "-" if text is None else f"{len(text.encode())}:{text}"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(level):
    """The levels of a tree over digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def plain_path(levels, i):
    path = []
    for level in levels[:-1]:
        run = i - i % 3
        path.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return path


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    trees, order = {}, sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for source, docs in by.items():
        docs.sort(key=lambda r: (r[0] is not None, r[0] or 0, H(*map(field, r))))
        trees[source] = plain_tree([H(*map(field, r)) for r in docs])
    top = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for at, source in enumerate(order):
        for i, r in enumerate(by[source]):
            path = plain_path(trees[source], i) + plain_path(top, at)
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            text = r[4].replace("\n", "") if even and r[4] is not None else r[4]
            node = H(*map(field, (*r[:4], text)))
            for before, after in path:
                node = H(*before, node, *after)
            proof = H(*[d for before, after in path for d in before + after])
            out.append((r[0], H(*map(field, r)), trees[source][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_of(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    frame.withColumns({"key": F.lit(1), "place": F.lit(2), "digest": F.lit("x")}).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, queries.op13_manifest(spark, str(tmp_path)).select(COLUMNS).collect()), key=repr)


def test_manifest_like_plain_trees(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 2)  # blocks of nine leaves, so that trees have several rounds
    pick = random.Random(3)
    sources = [None, "", "a", "b", "B", "é", "z-lone", "=", *[f"s{i}" for i in range(25)]]
    sizes = {"a": 400, "b": 81, "B": 82, None: 27, "é": 10, "": 3, "=": 2}
    rows = [(i * 7 + k, s, pick.choice(["en", None]), pick.choice([5, None]), pick.choice(["a\nb", "", None, "é\n\n", "plain"])) for i, s in enumerate(sources) for k in range(sizes.get(s, 1))]
    rows += [(None, "a", None, None, None), (1, "a", "en", 1, "same"), (1, "a", "en", 1, "same"), (1, "a", "en", 1, "other\n"), (-5, "b", None, None, "x" * 300_000 + "\n")]
    pick.shuffle(rows)
    assert manifest_of(spark, tmp_path, rows) == plain_manifest(rows)


def test_manifest_of_few_rows(spark, tmp_path):
    one = [(1, None, None, None, None)]
    assert manifest_of(spark, tmp_path, one) == plain_manifest(one)
    assert manifest_of(spark, tmp_path, one)[0][4] == H()  # no siblings
    assert manifest_of(spark, tmp_path, []) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 243])
def test_positions_in_the_log(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    height = merkle.height_of(n)
    log, levels = merkle.append_log(leaves, height), plain_tree([d.hex() for d in leaves])
    assert sum(map(len, levels)) == len(log)
    for h, level in enumerate(levels):
        places = merkle.position(h, list(range(len(level))), n)
        assert [log[p].hex() for p in places] == level


def test_tampering_shows(spark, docs):
    frame = docs(*[(i, f"line {i}\nend", "en", f"s{i % 3}") for i in range(50)])
    digest = merkle.leaf(F.col("doc_id"), F.col("text"))
    proofs = merkle.prove(merkle.build(frame, F.col("source"), [F.col("doc_id")], digest, [F.col("doc_id")])).collect()
    found = spark.createDataFrame(proofs, "digest binary, doc_id long, key string, path array<struct<before binary, after binary>>, subroot binary, root binary")
    other = merkle.fold(F.unhex(F.sha2(F.lit(b"x"), 256)), F.col("path"))
    row = found.select((merkle.fold(F.col("digest"), F.col("path")) == merkle.hexed(F.col("root"))).alias("ok"), (other == merkle.hexed(F.col("root"))).alias("bad"))
    assert row.distinct().collect() == [(True, False)]


# -- alignment


def plain_alignment(texts):
    """Per text: numbers, groups written out, and its links, by the tokenizers' own libraries and sets of bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(VOCABULARY_A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY_B)
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printing)}
    entry = {i: bytes(byte[c] for c in e) for e, i in a_tok.get_vocab().items() if i != 50256}
    out = []
    for text in texts:
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_tok.encode(text or "")
        of_a = [entry[i] for i in a]
        of_b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_tok.id_to_piece(i)]]
        if not text or b"".join(of_a) != b" " + text.encode() or b"".join(of_b) != b" " + text.encode():
            out.append((0, 0, "", []))
            continue
        spans = []
        for tokens in (of_a, of_b):
            at, mine = 0, []
            for t in tokens:
                mine.append((at, at + len(t)))
                at += len(t)
            spans.append(mine)
        cuts = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, here = [], ([], [])
        ia = ib = 0
        for cut in sorted(cuts):
            while ia < len(a) and spans[0][ia][1] <= cut:
                here[0].append(a[ia])
                ia += 1
            while ib < len(b) and spans[1][ib][1] <= cut:
                here[1].append(b[ib])
                ib += 1
            groups.append("|".join(",".join(map(str, x)) for x in here))
            here = ([], [])
        links, first = [], 0
        for x, (s, e) in zip(a, spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            k = first
            while k < len(b) and spans[1][k][0] < e:
                links.append((x, b[k]))
                k += 1
        out.append((len(a), len(b), ";".join(groups), links))
    return out


@pytest.mark.parametrize("frequent", [crosstoken.FREQUENT, 40, 0])
def test_alignment_like_plain_python(spark, tmp_path, monkeypatch, frequent):
    monkeypatch.setattr(crosstoken, "FREQUENT", frequent)
    monkeypatch.setattr(crosstoken, "CHUNK", 3000)
    monkeypatch.setattr(crosstoken, "PAIRS_KEPT", 700)
    prepared(spark)
    some = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts = [*ODD, *some, some[0], some[0]]
    spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, links int").repartition(5).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op12_alignment(spark, str(tmp_path)).collect()}
    wanted = plain_alignment(texts)
    assert sum(w[0] > 0 for w in wanted) > 60 and sum(w[0] == 0 for w in wanted) >= 3
    count = Counter(link for w in wanted for link in w[3])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    for i, (n_a, n_b, groups, links) in enumerate(wanted):
        r = got[i if i else None]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, groups.count(";") + 1 if groups else 0, len(links)), (i, texts[i][:50])
        assert r.groups_sha256 == (H(groups) if groups else "")
        assert (r.n_best, r.count_sum) == (sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links))


def test_alignment_keeps_columns_and_empty_tables(spark, docs):
    frame = docs((1, "one two"), (None, None))
    aligned = crosstoken.align(frame)
    assert aligned.columns == [*frame.columns, "alignment"]
    rows = {r.doc_id: r for r in aligned.collect()}
    assert rows[1].row == 7 and rows[None].alignment.n_a == 0 and rows[None].alignment.groups == ""
    empty = crosstoken.align(frame.limit(0))
    assert crosstoken.link_scores(empty, crosstoken.link_counts(empty)).collect() == []


# -- toxicity

NASTY = ["wretched", "scoundrel", "vermin", "lowlife"]


def labelled(n, seed=5):
    """Texts of random words; every fourth holds some of the nasty ones and is toxic."""
    pick = random.Random(seed)
    parts = ["ba", "len", "tor", "mi", "ras", "ken", "du", "pel", "so", "wim", "gar", "nit"]
    rows = []
    for i in range(n):
        words = ["".join(pick.choices(parts, k=pick.randint(1, 4))) for _ in range(pick.randint(60, 200))]
        if i % 4 == 0:
            for _ in range(6):
                words[pick.randrange(len(words))] = pick.choice(NASTY)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_toxic_texts_are_told_apart(spark, docs):
    rows = labelled(900)
    frame = docs(*[r[:2] for r in rows], (9000, None), (9001, ""), (9002, "¡" * 70_000), (9003, rows[0][1] + " " + rows[1][1] * 30), (None, "x y"))
    labels = spark.createDataFrame([(r[0], r[2], "extra") for r in rows] + [(None, 1, ""), (1, None, ""), (77777, 1, "")], "doc_id long, toxic int, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.fit(frame, labels.where(~held))
    scored = toxicity.score(frame, model)
    assert scored.columns == [*frame.columns, "toxicity"]
    found = {r.doc_id: r.toxicity for r in scored.where(held | F.col("doc_id").isNull() | (F.col("doc_id") >= 9000)).collect()}
    truth = {r[0]: r[2] for r in rows}
    mine = [(found[i].predicted, truth[i]) for i in found if i in truth]
    assert len(mine) > 200
    assert sum(p for p, t in mine if t) >= 0.9 * sum(t for _, t in mine)
    assert sum(p for p, t in mine if not t) <= 0.02 * len(mine)
    assert all(0 <= t.score <= 1 for t in found.values())
    every = {r.doc_id: r.toxicity for r in scored.collect()}
    assert all(every[i].predicted == 0 for i in (9000, 9001, 9002, None))
    assert every[9000] == every[9001]


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)], [(1, 1), (2, 0)], [(None, 1), (3, None)]])
def test_few_labels_give_scores(spark, docs, labels):
    frame = docs((1, "some text"), (2, "other words"), (3, None))
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = toxicity.score(frame, model).collect()
    assert len(rows) == 3 and all(0 <= r.toxicity.score <= 1 for r in rows)
    assert toxicity.score(frame.limit(0), model).count() == 0


def test_windows_cover_all_letters():
    for text in [*ODD, "word " * 500, "long" * 300]:
        whole = b"".join(toxicity.windows(text))
        assert whole.replace(b" ", b"") == toxicity._OTHER.sub(b"", (text or "").lower().encode())
        assert all(len(w) <= 2 * toxicity.WINDOW for w in toxicity.windows(text))


# -- sanitising long texts


def test_small_words_that_disclose(docs, tmp_path, spark):
    """The query marks every word that gives an entity away, however short; common short words stay."""
    rows = [(i, f"note {i} by zq at z@corp.example") for i in range(5)] + [(5, "zq is at home")]
    rows += [(10 + i, f"someone is at home by note {i}") for i in range(1500)]
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.QUERIES["op6_sanitise"](spark, str(tmp_path)).collect()}
    for i in range(5):
        text = rows[i][1]
        places = [s.split(":") for s in found[i].spans.split(",")]
        assert [(k, text[int(a) : int(b)]) for k, a, b in places] == [("email", "z@corp.example"), ("term", "zq")]
    assert found[5].spans == "term:0:2" and found[5].sanitised_text == "z* is at home"
    assert not any(found[10 + i].spans for i in range(1500))


def test_terms_of_a_text_with_many_different_words(docs):
    """Every word stands here alone, so each is marked where it stands; time must not grow with the square of the text."""
    pick = random.Random(9)
    words = ["".join(pick.choices("abcdefghij", k=8)) for _ in range(12_000)]
    text = " ".join(words) + " z@corp.example " + ", ".join(str(pick.randrange(10**6, 10**7)) for _ in range(3000))
    frame = docs((1, text), *[(10 + i, f"a short note {i}") for i in range(1500)])
    row = next(r for r in sanitise.find(frame).collect() if r.doc_id == 1)
    terms = [text[s.start : s.end] for s in row.spans if s.kind == "term"]
    assert terms[:12_000] == words and len(terms) == 15_000
    assert [(s.kind, text[s.start : s.end]) for s in row.spans if s.kind != "term"] == [("email", "z@corp.example")]
