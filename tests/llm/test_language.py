import zlib

import numpy as np

from rivulet.llm import language, queries


def test_tables_equal_the_network():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 110, 80).astype(np.uint8)) for _ in range(40)] + [bytes(rng.integers(105, 122, 80).astype(np.uint8)) for _ in range(40)]
    model = language.train(texts, ["a"] * 40 + ["b"] * 40, steps=60)
    x, _, _ = language.windows(texts)
    p, _, _ = language.forward(model, x)
    assert np.allclose(np.exp(language.Predictor(model).log_probabilities(x)), p, atol=1e-4)
    lang, score = language.Predictor(model).predict([*texts, b"", b"ab" * 5000])
    assert lang[:80] == ["a"] * 40 + ["b"] * 40 and lang[80] == "und" and score[80] == 0


def test_gradients():
    rng = np.random.default_rng(1)
    model = language.train([b"abc", b"xyz"], ["a", "b"], steps=1)
    for p in language.parameters(model):
        p += rng.normal(0, 0.05, p.shape).astype(np.float32)
    model = language.Model(model.languages, model.embedding.astype(float), [f.astype(float) for f in model.filters], [b.astype(float) for b in model.bias], model.weight.astype(float), model.weight_bias.astype(float))
    x = rng.integers(0, 30, (6, 20)).astype(np.uint8)
    y = rng.integers(0, 2, 6)
    loss = lambda: -np.log(language.forward(model, x)[0][np.arange(6), y]).mean()
    for p, g in zip(language.parameters(model), language.gradients(model, x, y), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_op5(spark, data, odd, empty, make_docs):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_language_id"](spark, data).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.9
    found = language.identify(odd, steps=5).collect()
    assert len(found) == odd.count()
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3, 6)} == {"und"}
    assert language.identify(empty).count() == 0
    unlabelled = language.identify(make_docs([(1, "some words", None), (2, "", None)]))
    assert [r.lang_pred for r in unlabelled.collect()] == ["und", "und"]


def test_labels_of_held_out_rows_are_not_seen(make_docs):
    rows = [(i, "hello words here", "en" if zlib.crc32(str(i).encode()) % 4 != 2 else "zz") for i in range(40)]
    assert language.learn(make_docs(rows), steps=2).languages == ["en"]
    assert language.learn(make_docs([(1, "abc", None)]), steps=2).languages == []


def test_every_label_is_learned(make_docs, monkeypatch):
    monkeypatch.setattr(language, "MOST_ROWS", 300)
    ids = [i for i in range(700) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"words of text {i}", f"l{k % 250:03}") for k, i in enumerate(ids)] + [(1000 + i, f"more common words {i}", "en") for i in range(300)]
    assert language.learn(make_docs(rows), steps=1).languages == ["en", *[f"l{k:03}" for k in range(250)]]
