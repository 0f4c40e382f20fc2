import zlib

import numpy as np

from citylake.llm import bigru
from citylake.llm import language_id as li
from tests.llm.fixtures import clashing, docs_of, documents, empty_documents, odd_documents


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = bigru.Weights.random(3, 2, 1)
    for name in ("table", "hidden", "bias", "out", "out_bias"):
        setattr(w, name, getattr(w, name).astype("f8"))
    windows, labels = rng.integers(0, 256, (4, 6)).astype("u1"), np.array([0, 1, 1, 0])
    _, gradients = bigru.loss_and_gradients(w, windows, labels)
    for v, g in zip(w.arrays(), gradients.arrays()):
        for place in rng.permutation(np.flatnonzero(np.abs(g.ravel()) > 1e-7))[:12]:
            was, found = v.flat[place], []
            for step in (1e-5, -1e-5):
                v.flat[place] = was + step
                found.append(bigru.loss_and_gradients(w, windows, labels)[0])
            v.flat[place] = was
            assert abs((found[0] - found[1]) / 2e-5 - g.flat[place]) < 1e-6


def plain_positions(w, text):
    """Class probabilities of every position, one step after the other."""
    h, states = None, []
    for d, data in ((0, text), (1, text[::-1])):
        h, seen = np.zeros(w.bias.shape[1]), []
        for b in data:
            a, g = w.table[d, b].astype("f8"), h @ w.hidden[d].astype("f8")
            size = len(h)
            gate = 1 / (1 + np.exp(-(a[: 2 * size] + g[: 2 * size])))
            n = np.tanh(a[2 * size :] + gate[size:] * (g[2 * size :] + w.bias[d]))
            h = n + gate[:size] * (h - n)
            seen.append(h)
        states.append(np.array(seen))
    logits = states[0] @ w.out[0] + states[1][::-1] @ w.out[1] + w.out_bias
    p = np.exp(logits)
    return p / p.sum(1, keepdims=True)


def test_reading_many_windows_equals_reading_one():
    w, rng = bigru.Weights.random(4, 3, 5), np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 256, n).astype("u1")) for n in (1, 5, 16, 17, 40, 3)] + [b""]
    got = bigru.Reader(w).pooled(texts, t_max=16, block=4)
    for text, p in zip(texts, got):
        parts = [plain_positions(w, text[i : i + 16]) for i in range(0, len(text), 16)]
        assert np.allclose(p, np.concatenate(parts).mean(0) if parts else 0, atol=1e-5)


def test_held_out_accuracy_and_contract(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = li.fit(docs)
    rows = li.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.97
    odd = {r["doc_id"]: r for r in li.identify(odd_documents(spark), model).collect()}
    assert all(odd[k]["lang_pred"] == "und" for k in (1, 2, 3, 8, 9)) and odd[4]["lang_pred"] in model.languages
    assert odd[None]["held_out"]
    kept = li.accepted(clashing(odd_documents(spark), "lang_pred", "score", "doc", "held_out"), model)
    assert kept.columns == [*odd_documents(spark).columns, "lang_pred", "score", "doc", "held_out"]
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3, 8, 9})
    assert li.accepted(docs, model).count() >= 0.995 * docs.count()


def test_the_label_of_a_prediction_is_no_input(spark):
    docs = documents(spark)
    model = li.fit(docs, steps=40)
    blind = docs.withColumn("lang", li.F.lit(None).cast("string")).withColumn("source", li.F.lit("other"))
    assert sorted(li.identify(docs, model).collect()) == sorted(li.identify(blind, model).collect())
    held = docs.withColumn("lang", li.F.when(li.held_out(), "xx").otherwise(li.F.col("lang")))
    assert "xx" not in li.fit(held, steps=2).languages


def test_nothing_to_learn_from(spark):
    model = li.fit(empty_documents(spark))
    assert model.languages == [] and li.identify(empty_documents(spark), model).count() == 0
    assert {r["lang_pred"] for r in li.identify(docs_of(spark, [(1, "some words")]), model).collect()} == {"und"}


def many_languages(spark, n=70, each=30):
    """Every language has letters of its own; the rarest has one document only, copied."""
    rows = []
    for k in range(n):
        letters = [chr(0x4E00 + 64 * k + j) for j in range(8)]
        for i in range(each if k else 5):
            word = lambda j: "".join(letters[(i * j + j + m) % 8] for m in range(4))
            rows.append((k * 1000 + (i if k else 0), " ".join(word(j) for j in range(12 if k else 3)), f"l{k:03}", "s"))
    return docs_of(spark, rows)


def test_more_languages_than_64_are_learned(spark):
    docs = many_languages(spark)
    want = {r["lang"] for r in docs.filter(~li.held_out()).select("lang").distinct().collect()}
    assert len(want) > 64
    model = li.fit(docs)
    assert set(model.languages) == want
    rows = li.identify(docs, model).join(docs.select("doc_id", "lang").distinct(), "doc_id").filter("held_out").collect()
    right = [r["lang_pred"] == r["lang"] for r in rows if r["lang"] in want]
    assert sum(right) / len(right) > 0.9


def test_copies_do_not_crowd_out_a_language(spark):
    docs = docs_of(spark, [(1, "the same words", "aa", "s")] * 3000 + [(k, f"other words {k}", "bb", "s") for k in range(2, 40)])
    languages, rows = li.sample(docs, per_language=5)
    assert languages == ["aa", "bb"] and {lang for lang, _ in rows} == {"aa", "bb"} and len(rows) < 100


def test_threshold_follows_the_classes():
    labels = np.arange(200) % 2
    windows = (97 + labels[:, None] + np.zeros((1, 64))).astype("u1")
    assert 0.6 < li.trusted_from(bigru.train(windows, labels, 2, steps=60), windows, labels) < 0.75
    blank = bigru.Weights.random(3, 64, 1)
    for v in blank.arrays():
        v[:] = 0
    assert abs(li.trusted_from(blank, windows, np.arange(200) % 64) - 1 / 64) < 1e-6
    assert li.trusted_from(bigru.Weights.random(3, 1, 1), windows, 0 * labels) == 0
