"""The pipeline's stages against brute force, each on its own input."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as cp
from ledgerloom.llm import common, decontaminate, near_dedup
from tests.llm import test_decontaminate, test_mixing, test_near_dedup, test_token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
INSULTS = ["idiot", "scum", "worthless", "trash", "loser"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small copy of the tables with planted cases, and odd rows."""
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(30)) for i in range(5)]
    docs, toxic = [], set()
    for i in range(400):
        words = say(rng.randrange(30, 120)).split()
        if i % 5 == 0:
            toxic.add(i)
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        docs.append((i, " ".join(words), "en", f"s{i % 3}"))
    for i in range(400, 440):       # copies with one word changed, and exact ones
        words = docs[i - 399][1].split()
        if i % 2:
            words[3] = "changed"
        docs.append((i, " ".join(words), "en", "s1"))
    for i in range(440, 450):       # benchmark passages
        docs.append((i, f"{say(20)} {' '.join(items[i % 5][1].split()[5:25])} {say(20)}", "en", "s2"))
    docs += [(450, None, None, None), (451, "", "en", "s0"), (452, "alone", None, None), (None, "no id", "en", "s0"),
             (453, "said twice " + say(9), "en", "s1")]
    docs.append(docs[-1])
    where = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], SCHEMA).write.parquet(str(where / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(where / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(440)], "doc_id long, quality int, toxic int").write.parquet(
        str(where / "labels.parquet"))
    return str(where)


@pytest.fixture(scope="module")
def results(spark, folder):
    """Input of the first stage and the result of each."""
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in cp.STAGES:
        out.append(common.staged(stage(spark, out[-1], folder), "pipeline-test"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(results):
    assert [n for n, _ in cp.STAGES] == [
        "toxicity", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
        "token-ID / binary output"]
    for result in results[1:-1]:
        assert result.columns == results[0].columns


def test_toxic_documents_go(results):
    before, after = (Counter(pairs(r)) for r in results[:2])
    assert not after - before
    gone, toxic = set(before - after), {p for p in before if p[1] and sum(w in INSULTS for w in p[1].split()) >= 3}
    assert len(gone & toxic) >= 0.97 * len(toxic) and len(gone - toxic) <= 2


def test_one_of_each_group_stays(results):
    before, after = (pairs(r) for r in results[1:3])
    named = [(i, t) for i, t in before if i is not None]
    component = {i: c for i, (_, c) in test_near_dedup.brute(dict(named).items(), 5, 80).items()}
    assert sorted(i for i, _ in after if i is not None) == sorted({i for i in component if component[i] == i})
    assert Counter(t for i, t in after if i is None) == Counter(t for i, t in before if i is None)


def test_contaminated_documents_go(spark, folder, results):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before, after = (pairs(r) for r in results[2:4])
    clean = [(i, t) for i, t in before if not test_decontaminate.brute([(i, t)], items)[i][1]]
    assert Counter(after) == Counter(clean) and len(clean) < len(before)


def test_mix_meets_targets(results):
    rows = [(r.doc_id, r.text, r.source) for r in results[3].collect()]
    taken = [(r.doc_id, r.text, r.source) for r in results[4].collect()]
    size, target = test_mixing.expected_targets(rows)
    words = defaultdict(int)
    for _, text, source in taken:
        words[source] += len((text or "").split())
    for source in size:
        assert words[source] <= target[source] + 1e-6
        assert words[source] >= target[source] - max(0.05 * size[source], 5)
    many = Counter(taken)
    assert set(many) <= set(rows) and max(many.values()) <= 3


def test_token_files_hold_the_mix(results):
    rows = pairs(results[4])
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in results[5].collect())
    wanted = test_token_files.expected([(i if i is not None else 1 << 62, t) for i, t in rows])
    strip = lambda x: Counter((i if i is not None else 1 << 62, n, c) for i, n, c in x)
    assert strip((i, n, c) for _, i, n, c in found) == strip((i, n, c) for i, _, n, c in wanted)
    ends = [s + n for s, _, n, _ in found]
    assert [s for s, *_ in found] == [0, *ends[:-1]]
    ids = [i for _, i, _, _ in found if i is not None]
    assert ids == sorted(ids)


def test_run_gives_the_same(spark, folder, results):
    assert Counter(map(tuple, cp.run(spark, folder).collect())) == Counter(map(tuple, results[-1].collect()))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []
