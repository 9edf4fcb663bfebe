"""Toxicity, language and quality: kernels against their definition, accuracy on the held-out fold, odd inputs."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from billscope.llm import language, quality, toxicity
from billscope.llm.common import sigmoid
from billscope.llm.queries import QUERIES, fitted_toxicity, prepared
from billscope.llm.svm import fit_logistic, fit_svm

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n "), (4, "1234 !!"), (None, "some words here"), (5, "x" * 200_000), (6, "same"), (6, "same"), (7, "日本 語 テキスト"), (8, "a b c d e f")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "s", 1.5) for i, t in ODD]
    return prepared(spark).createDataFrame(rows, "doc_id long, text string, score string, predicted double")


def labelled(spark, name, column):
    found = QUERIES[name](spark, SF).collect()
    if column == "lang":
        truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    else:
        truth = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    return [(r, truth[r["doc_id"]]) for r in found if r["doc_id"] in truth and r["held_out"]]


def subsequences(window):
    """Weights of a window's subsequences, kept apart by where in a word they begin."""
    letters = [(c, min(k, 3)) for word in window.split() for k, c in enumerate(word)]
    out = {}
    for n, share in ((3, 0.4), (4, 1.0)):
        for places in combinations(range(len(letters)), n):
            span = places[-1] - places[0] + 1
            if places[0] < toxicity.WINDOW and span <= n + toxicity.GAPS:
                part = (0, 1, 1, 2)[letters[places[0]][1]]
                key = (part, "".join(letters[p][0] for p in places))
                out[key] = out.get(key, 0.0) + share * toxicity.DECAY**span
    return out


WINDOWS = ["idiot", "an idxiot goes there", "worthless", "abcabcabcabcabcabc", "i d i o t", "ze bra", ""]


def test_kernel_is_the_gapped_subsequence_kernel():
    rows, _ = toxicity.rows_of(WINDOWS)
    for i, a in enumerate(WINDOWS):
        for j, b in enumerate(WINDOWS):
            sa, sb = subsequences(a), subsequences(b)
            want = sum(v * sb.get(k, 0) for k, v in sa.items()) / toxicity.SCALE**2
            assert abs(float(rows[i] @ rows[j]) - want) < 1e-4


def test_folded_margins_equal_the_features():
    """A window's sum over the table is what its subsequence weights give, in a text of any other letters."""
    rng = np.random.default_rng(3)
    rows, used = toxicity.rows_of(WINDOWS)
    table = np.zeros(3 * toxicity.TABLE, dtype=np.float32)
    table[used] = rng.normal(size=len(used))
    letters = toxicity.Letters(pa.array(WINDOWS, pa.large_string()))
    folded = letters.windows(table)[letters.starts[:-1]]
    assert np.allclose(folded, rows @ table[used] * toxicity.SCALE, atol=1e-3)


def test_telling_sequences_in_samples_of_any_balance(spark):
    counts = spark.createDataFrame([("mark", 60, 2), ("common", 90, 80), ("rare", 1, 0)], "gram string, toxic long, clean long")
    for n_clean in (100, 1000, 20_000):
        assert [r["gram"] for r in toxicity.surprising(counts, 100, n_clean).collect()][:1] == ["mark"]
    assert [r["gram"] for r in toxicity.surprising(counts, 100, 100).collect()] == ["mark"]


def test_texts_of_a_batch_do_not_touch():
    table = np.zeros(3 * toxicity.TABLE, dtype=np.float32)
    table[toxicity.rows_of(["idiot"])[1]] = 1.0
    model = toxicity.Model(table, -0.5, np.array([1.0, 0.0]), 0.0)
    texts = ["the river", "", "idiot", "of", "", "old an idiot"]
    together = toxicity.evidence(model, pa.array(texts, pa.large_string()))
    alone = np.concatenate([toxicity.evidence(model, pa.array([t], pa.large_string())) for t in texts])
    assert np.allclose(together, alone) and (together[[2, 5], 0] > 0).all() and (together[[0, 1, 3, 4], 0] == -0.5).all()


def test_letters_fold_and_drop(monkeypatch):
    texts = ["I.d-I_o T", "", "éß", "123", "1d10t 55", "ab c"]
    letters = toxicity.Letters(pa.array(texts, pa.large_string()))
    assert letters.sizes.tolist() == [5, 0, 2, 0, 5, 3]
    spelled = [letters.spelled(a, n) for a, n in zip(letters.starts.tolist(), letters.sizes.tolist())]
    assert spelled[0] == "i d i o t" and spelled[4] == "idiot" and spelled[5] == "ab c"
    whole = letters.sums(np.arange(3 * toxicity.TABLE, dtype=np.float32))
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    assert np.array_equal(whole, letters.sums(np.arange(3 * toxicity.TABLE, dtype=np.float32)))


def test_margin_machines():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.1, 1.0, -1.0)
    for rows, width in ((x, 5), (np.hstack([x, rng.normal(size=(300, 400)) * 0.01]), 405)):
        w, bias = fit_svm(rows, y)
        assert w.shape == (width,) and (np.sign(rows @ w + bias) == y).mean() > 0.97
    w, bias = fit_logistic(x[:, :2], (y > 0).astype(float))
    assert w[0] > w[1] > 0


INSULTS = "idiot clown loser trash worthless moron scum pathetic stupid disgusting".split()


def test_toxicity_on_the_held_out_fold(spark):
    rows = labelled(spark, "op1_toxicity", "toxic")
    assert np.mean([r["predicted"] == truth for r, truth in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r, _ in rows)
    clean = [r["predicted"] for r, truth in rows if truth == 0]
    assert np.mean(clean) < 0.03
    texts = {r["doc_id"]: r["text"].lower() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = [r["predicted"] for r, truth in rows if truth == 1 and any(w in texts[r["doc_id"]] for w in INSULTS)]
    assert len(found) >= 14 and np.mean(found) > 0.95  # toxic documents without any of the words are label noise


def test_insults_in_clean_sentences(spark):
    """Learned at the smallest useful scale: single insults, disguised ones, and harmless neighbours."""
    model = fitted_toxicity(prepared(spark), SF)
    sentence = "The river runs along old stones. You are a {} of mine today. We walk home under quiet trees."

    def found(words):
        seen = toxicity.evidence(model, pa.array([sentence.format(w) for w in words], pa.large_string()))
        return (sigmoid(seen @ model.scale + model.shift) >= 0.7).tolist()

    five = INSULTS[:5]
    assert all(found(five)) and all(found([w.upper() for w in five]))
    assert not any(found("closer crown brown idiom patriot crash river".split()))
    disguised = [f for w in five for f in (w[:2] + "x" + w[2:], " ".join(w), w[:2] + " " + w[2:], f"you{w}andfool", w.replace("o", "0"))]
    assert np.mean(found(disguised)) >= 0.5


def test_toxicity_tolerates_disguise(spark):
    spark = prepared(spark)
    insults, plain = ["grobian", "schurke"], "the river runs along old stones under quiet trees near green hills".split()
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        words = list(rng.choice(plain, 12))
        if i % 3 == 0:
            words[4] = insults[i % 2]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    tests = ["the grobian runs", "the g r o b i a n runs", "the gro-bian runs", "the groobian runs", "the grxobian runs", "the Schurke runs", "the river runs", "old green hills"]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).collect()}
    assert [got[i] for i in range(len(tests))] == [1, 1, 1, 1, 1, 1, 0, 0]


def test_language_on_the_held_out_fold(spark):
    rows = labelled(spark, "op4_language", "lang")
    assert np.mean([r["lang_pred"] == truth for r, truth in rows]) > 0.98


def test_quality_on_the_held_out_fold(spark):
    rows = labelled(spark, "op10_quality", "quality")
    assert np.mean([r["predicted"] == truth for r, truth in rows]) > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.3) for r, _ in rows)


def test_odd_documents(spark, odd):
    labels = odd.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic", "cast(doc_id % 2 as int) as quality")
    for model in (None, toxicity.fit(odd, labels)):
        assert toxicity.score(odd, model).count() == len(ODD)
    trees = quality.fit(odd, labels)
    for model in (None, trees):
        got = quality.score(odd, model).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    known = odd.selectExpr("doc_id", "text", "case when doc_id > 5 then 'en' end as lang")
    for model in (None, language.fit(known)):
        got = [(r["doc_id"], r["lang_pred"]) for r in language.identify(odd, model).collect()]
        assert len(got) == len(ODD) and all((i, "und") in got for i in (1, 2, 3, 4))
        assert model is None or (7, "en") in got


def test_empty_tables(spark, odd):
    none = odd.where("false")
    labels = none.selectExpr("doc_id", "1 as toxic", "1 as quality")
    assert toxicity.fit(none, labels) is None and quality.fit(none, labels) is None
    assert language.fit(none.selectExpr("doc_id", "text", "score as lang")) is None
    assert toxicity.score(none, None).collect() == quality.score(none, None).collect() == language.identify(none, None).collect() == []


def test_three_related_languages_and_families():
    texts = {"de": "der hund und die katze schlafen nicht auf der straße", "nl": "de hond en de kat slapen niet op het huis", "sv": "hunden och katten sover inte på vägen", "fr": "le chien et le chat ne dorment pas dans la rue", "xx": "zub gorp mlek zarf quon"}
    langs = np.array([lang for lang in texts for _ in range(3)], dtype=object)
    matrix = language.features(pa.array([texts[lang] + " " * i for i, lang in enumerate(langs)], pa.large_string()))
    families = {}
    for lang in sorted(texts):
        families.setdefault(language.family_of(lang), []).append(lang)
    assert families == {"germanic": ["de", "nl", "sv"], "romance": ["fr"], "xx": ["xx"]}
    own = np.array([language.family_of(lang) for lang in langs], dtype=object)
    model = language.Model(families, language.duels(sorted(families), own, matrix), {f: language.duels(m, langs, matrix) for f, m in families.items()})
    found, score = model.predict(matrix)
    assert found.tolist() == langs.tolist() and ((score > 0) & (score <= 1)).all()


def test_statistics_against_plain_python():
    texts = ["One two two.\nOne two two.\nEND!!", "", "é ß", "| a | a |"]
    rows = quality.statistics(pa.array(texts, pa.large_string()))
    name = quality.NAMES.index
    assert rows[0, name("log_words")] == np.float32(np.log1p(7)) and abs(rows[0, name("distinct_words")] - 4 / 7) < 1e-6
    assert abs(rows[0, name("distinct_lines")] - 2 / 3) < 1e-6 and abs(rows[0, name("shout")] - 2 / len(texts[0])) < 1e-6
    assert rows[1, name("log_bytes")] == 0 and np.isfinite(rows).all()
    assert abs(rows[3, name("symbol_ends")] - 3 / 5) < 1e-6


def test_flat_trees_equal_walking_them():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality.boost(x, y, n_trees=20, depth=3)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.95

    def walk(row):
        total = trees.start
        for feature, limit, leaf in zip(trees.feature, trees.limit, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > limit[node])
            total += leaf[node - len(feature)]
        return total

    assert np.allclose([walk(row) for row in x[:50]], trees.margin(x[:50]))
