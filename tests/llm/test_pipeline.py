"""The pipeline from end to end, stage by stage."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from conftest import rows

import corpus_pipeline
from tidemark.llm import decontaminate, grade, simhash
from tidemark.llm.common import read, stored

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_decide(spark):
    docs = read(spark, SF, "documents")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id for r in docs.collect()}
        after = stored(stage(spark, docs, SF), f"test-{name}")
        assert after.columns == columns
        kept = {r.doc_id for r in after.collect()}
        assert len(kept) == after.count() and kept <= before
        if name == "quality_classifier":
            judged = grade.grade_documents(docs, grade.ratings_from_labels(read(spark, SF, "labels")))
            assert kept == {r.doc_id for r in judged.filter("kept").collect()}
        if name == "near_duplicates":
            groups = simhash.near_duplicates(docs)
            assert kept == {r.component_id for r in groups.collect()}
        if name == "decontamination":
            hits = decontaminate.contaminated(docs, read(spark, SF, "benchmark")).collect()
            dropped = {texts[r.doc_id] for r in hits}
            assert kept == {i for i in before if texts[i] not in dropped}
        if name == "personal_data":
            assert kept == before
            for r in after.collect():
                assert r.n_chars == len(r.text) and "@example" not in r.text
        docs = after
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    wanted = []
    for r in docs.collect():
        ids = np.array(encoding.encode_ordinary(r.text or ""), "<u4")
        digests = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), (r.text or "").encode())]
        wanted.append((r.doc_id, len(ids), *digests))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows(corpus_pipeline.run(spark, SF), *names) == sorted(wanted)
