"""Operators of a training-data pipeline, and their queries."""

from tallystone.llm import ball_search, collocations, decontaminate, exact_dedup, license_scan, lm_score, mixing, near_join, pseudonyms, quality, secret_scan, toxicity, warc

QUERIES = {
    "op1_secrets": secret_scan.op1_secrets,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_warc": warc.op3_warc,
    "op4_near_join": near_join.op4_near_join,
    "op5_quality": quality.op5_quality,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_pfair_mix": mixing.op7_pfair_mix,
    "op8_lm_score": lm_score.op8_lm_score,
    "op9_pseudonyms": pseudonyms.op9_pseudonyms,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_ball_search": ball_search.op11_ball_search,
    "op12_collocations": collocations.op12_collocations,
    "op13_license_scan": license_scan.op13_license_scan,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op3_warc": warc.OP3_SQL,
    "op4_near_join": near_join.OP4_SQL,
    "op7_pfair_mix": mixing.OP7_SQL,
    "op10_decontaminate": decontaminate.OP10_SQL,
    "op11_ball_search": ball_search.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_license_scan": license_scan.OP13_SQL,
}
