"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import codes, decontam, jpeg, langid, lines, packing, pieces, quality, resampling, secrets, sharding, simhash, urls

QUERIES = {
    f.__name__: f
    for f in (
        quality.op1_cotraining_quality,
        jpeg.op2_progressive_jpeg,
        urls.op3_url_filter,
        lines.op4_line_dedup,
        secrets.op5_secret_ledger,
        langid.op6_language_id,
        pieces.op7_nbest_pieces,
        simhash.op8_simhash_near_dedup,
        sharding.op9_two_pass_shuffle,
        decontam.op10_pigeonhole_decontamination,
        resampling.op11_importance_resampling,
        codes.op12_vector_codes,
        packing.op13_best_fit_packing,
    )
}
ORACLES = {"op3_url_filter": urls.ORACLE, "op5_secret_ledger": secrets.ORACLE, "op11_importance_resampling": resampling.ORACLE, "op12_vector_codes": codes.ORACLE}
