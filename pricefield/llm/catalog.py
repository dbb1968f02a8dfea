"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from .collocations import OP11_SQL, op11_collocations
from .decontamination import OP10_SQL, op10_decontamination
from .extraction import op4_extraction
from .jaccard import OP7_SQL, op7_jaccard
from .licenses import op9_licenses
from .manifest import OP12_SQL, op12_manifest
from .minmax import OP13_SQL, op13_minmax
from .mixing import OP6_SQL, op6_mixing
from .quality import op1_quality
from .secrets import OP3_SQL, op3_secrets
from .sharding import op8_sharding
from .urls import op5_urls
from .warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_secrets": op3_secrets,
    "op4_extraction": op4_extraction,
    "op5_urls": op5_urls,
    "op6_mixing": op6_mixing,
    "op7_jaccard": op7_jaccard,
    "op8_sharding": op8_sharding,
    "op9_licenses": op9_licenses,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_manifest": op12_manifest,
    "op13_minmax": op13_minmax,
}
ORACLES = {
    "op2_warc": OP2_SQL,
    "op3_secrets": OP3_SQL,
    "op6_mixing": OP6_SQL,
    "op7_jaccard": OP7_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_manifest": OP12_SQL,
    "op13_minmax": OP13_SQL,
}
