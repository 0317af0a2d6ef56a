import hashlib
import re

import pytest
import public_tokenizers
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from isobar.staging import stage
from isobar.llm import classifier, pii

from .helpers import SMALL, documents
from .test_mixing import by_hand
from .test_simhash import plain_groups, plain_print


def test_run_equals_plain_code(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = classifier.quality_model(table, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = table.orderBy("doc_id").collect()
    scores = model.score(classifier.table([r.text for r in rows]))
    good = [r for r, s in zip(rows, scores) if s >= 0.7]
    groups = plain_groups({r.doc_id: plain_print(r.text) for r in good})
    single = [r for r in good if groups[r.doc_id] == r.doc_id]
    assert 0 < len(single) < len(good) < len(rows)
    weights = pii.fit(spark.createDataFrame(single))
    clean = {r.doc_id: (pii.masked(r.text, weights), r.source, r.lang) for r in single}
    words = {i: re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t) for i, (t, _, _) in clean.items()}
    sizes = {}
    for i, (_, source, _) in clean.items():
        sizes[source] = sizes.get(source, 0) + len(words[i])
    targets = by_hand(sizes, (3, 1, 2), 1.5, 2)
    # Blocks of 8 words by highest quotient; every source here is a single shard.
    assert max(sizes.values()) <= 32768
    total, blocks = int(sum(targets.values()) / 8 + 0.5), dict.fromkeys(sizes, 0)
    for _ in range(total):
        blocks[max(sorted(sizes), key=lambda s: targets[s] / (2 * blocks[s] + 1))] += 1
    number = lambda *parts: int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = []
    for source, size in sizes.items():
        order = sorted((i for i in clean if clean[i][1] == source), key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest())
        stream = [(i, w) for i in order for w in range(len(words[i]))]
        length = min(blocks[source], size * 2 // 8) * 8
        first = number("mix", source, 0) % max(size // 8, 1) * 8
        place = first
        while place < first + length:  # one row per stretch of a document in one pass
            i, w = stream[place % size]
            n = min(len(words[i]) - w, first + length - place)
            whole, _, lang = clean[i]
            text = whole if n == len(words[i]) else "".join(words[i][w : w + n])
            wanted.append((i, source, lang, tuple(library.encode(text, add_bos=True, add_eos=True))))
            place += n
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert sorted((r.doc_id, r.source, r.lang, tuple(r.ids)) for r in got) == sorted(wanted)


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, name, step):
    for frame in (documents(spark), documents(spark).unionByName(documents(spark)), documents(spark, [])):
        made = step(spark, frame, SMALL)
        rows = made.collect()
        assert rows or not frame.count() or name == "quality"
        if name != "pieces":
            assert made.columns == frame.columns and made.dtypes == frame.dtypes


def test_ids_of_the_last_stage_read_back_as_the_text(spark):
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for frame in (documents(spark), spark.read.parquet(f"{SMALL}/documents.parquet").limit(50)):
        frame = stage(frame, "some")
        texts = {r.doc_id: r.text for r in frame.collect()}
        rows = corpus_pipeline.to_pieces(spark, frame, SMALL).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert r.decoded_sha256 == hashlib.sha256(library.decode(library.encode(texts[r.doc_id] or "")).encode()).hexdigest()
