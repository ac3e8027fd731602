from orderloom.llm import context_mixing as cm
from orderloom.llm import decontamination, overlap, simhash


def test_mixer_weights_are_fitted_on_all_training_texts(documents, monkeypatch):
    df, fitted = documents(*((k, f"w{k % 7}") for k in range(6000))), []
    fit = cm.mixer_weights
    monkeypatch.setattr(cm, "mixer_weights", lambda texts, model: fitted.append(texts.count()) or fit(texts, model))
    cm.score_texts(df)
    assert fitted == [df.where(~cm.held_out("doc_id")).count()]


def test_near_copies_are_found_by_fingerprints_and_verified(documents, monkeypatch):
    words = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (3, " ".join(words[::-1])), (4, None)]
    # Without a band that meets, signatures alone bring the pairs; of those that share a print only near copies are linked.
    monkeypatch.setattr(overlap, "_first_pairs", lambda members: members.select("band", "node").toDF("a", "b").limit(0))
    monkeypatch.setattr(overlap, "_open_pairs", lambda members, label, block: members.select("band", "node").toDF("a", "b").limit(0))
    monkeypatch.setattr(simhash, "fingerprint", lambda text, width=4: (5 if text.startswith("w0 ") else 0,))
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(*rows), wide=True).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}


def test_lookups_hold_few_rows(documents, spark, monkeypatch):
    asked, mapped = [], decontamination.map_rows

    def seen(df, run, schema, rows=2000):
        asked.append(rows)
        return mapped(df, run, schema, rows)

    monkeypatch.setattr(decontamination, "map_rows", seen)
    benchmark = spark.createDataFrame([(1, "one two three. four five.")], "item_id bigint, text string")
    decontamination.remove_leaks(documents((1, "a")), benchmark)
    assert asked[-1] <= 256
