"""rillflow: meter-reading batch analytics expressed as Spark DataFrame plans.

Modules:
    functions  - scalar Column builders (parsing, identity hashes, falsy rules)
    sources    - file listing, whole-file JSON scans, record normalisation, history reads
    operators  - dedup, header/body flattening, anomaly detection, keyed stores, report tables
    sinks      - JSON / CSV / report writers
    plans      - end-to-end batch run and the driver query catalogue
    streaming  - incremental ingest of new files into the keyed store
"""

from rillflow.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
