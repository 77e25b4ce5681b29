"""Each stage of the pipeline against brute force on what the stage before it kept."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tarmaq.llm.sentence_pieces import Pieces, default_model
from tarmaq.llm.surrogates import find
from tests.llm.test_jaccard import brute
from tests.llm.test_rules_and_mix import fill, repeat_words

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(docs.limit(3))  # repeated rows
    path = str(folder / "input")
    docs.write.parquet(path)
    out = [spark.read.parquet(path)]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], DATA).write.parquet(str(folder / str(number)))
        out.append(spark.read.parquet(str(folder / str(number))))
    return out


def test_columns_stay(stages):
    for result in stages[1:-1]:
        assert result.dtypes == stages[0].dtypes


def test_quality_rules_keep_clean_documents(stages):
    kept = Counter(r.doc_id for r in stages[1].collect())
    for r in stages[0].collect():
        words = (r.text or "").encode().split()
        bad = len(words) < 50 or 100 * repeat_words(r.text) > 50 * len(words)
        if bad:
            assert r.doc_id not in kept
    clean = [r for r in stages[0].collect() if 100 <= len((r.text or "").split())
             and repeat_words(r.text) == 0 and not set("#*$%&|<>") & set(r.text)
             and len(set(r.text.split("\n"))) == len(r.text.split("\n"))]
    assert clean and all(r.doc_id in kept for r in clean)


def test_one_of_each_group_stays(stages):
    rows = [(i, r.text) for i, r in enumerate(sorted(stages[1].collect(),
                                                     key=lambda r: r.doc_id))]
    groups = Counter(low for low, _ in brute(rows).values())
    assert stages[2].count() == len(groups) < len(rows)
    kept = [(i, r.text) for i, r in enumerate(stages[2].collect())]
    assert all(links == 0 for _, links in brute(kept).values())


def test_surrogates_replace_every_entity(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    changed = 0
    for i, r in before.items():
        names = {e.name for e in find(r.text)}
        assert not names & {e.name for e in find(after[i].text)}
        assert after[i].n_chars == len(after[i].text)
        assert names or after[i] == r
        changed += bool(names)
    assert changed


def test_mix_comes_near_its_targets(stages):
    size = {r.doc_id: len(r.text.encode().split()) for r in stages[3].collect()}
    sources: Counter = Counter()
    for r in stages[3].collect():
        sources[r.source] += size[r.doc_id]
    wanted = fill(dict(sources), (3.0, 1.0, 2.0), 1.5, 2.0)
    taken: Counter = Counter()
    for r in stages[4].collect():
        taken[r.source] += size[r.doc_id]
    assert max(Counter(r.doc_id for r in stages[4].collect()).values()) <= 2
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= max(size.values())


def test_pieces_spell_the_texts(stages):
    spelled = Pieces.from_model(default_model()).texts
    texts = Counter((r.doc_id, r.text) for r in stages[4].collect())
    found = Counter((r.doc_id, b"".join(spelled[i] for i in r.ids)[1:].decode())
                    for r in stages[5].collect())
    assert found == texts


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
