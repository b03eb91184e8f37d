"""Incremental ingest: files arriving in two waves are upserted once each (restart-safe)."""

import tempfile

from rillflow.operators import store as S
from rillflow.streaming.ingest import ingest_new_files

from fixtures import sample_document, worked_history_documents, write_json


def test_ingest_new_files_twice(spark):
    base = tempfile.mkdtemp(prefix="rillflow-stream-", dir="/tmp")
    inbox, store, ckpt = f"{base}/inbox", f"{base}/store", f"{base}/ckpt"
    write_json(inbox, "a_20251022.json", sample_document())
    ingest_new_files(spark, inbox, store, checkpoint=ckpt)
    assert S.current(spark, store).count() == 1
    for i, doc in enumerate(worked_history_documents()):
        write_json(inbox, f"h_{i}.json", doc)
    ingest_new_files(spark, inbox, store, checkpoint=ckpt)   # resumes: only the new files
    cur = S.current(spark, store)
    assert cur.count() == 3
    assert S.read_versions(spark, store).count() == 3
