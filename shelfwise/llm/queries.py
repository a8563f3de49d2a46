"""The registered queries of this subpackage and the SQL that checks them."""

from shelfwise.llm import collocations, decontamination, exact_dedup, language, licenses, lm, mixing, repetition, simhash, spelling, substrings, token_files, toxicity

OPERATORS = (
    licenses.op1_licenses,
    decontamination.op2_decontamination,
    lm.op3_lm,
    simhash.op4_simhash,
    substrings.op5_substrings,
    mixing.op6_mixing,
    language.op7_language,
    toxicity.op8_toxicity,
    repetition.op9_repetition,
    token_files.op10_token_files,
    collocations.op11_collocations,
    exact_dedup.op12_exact_dedup,
    spelling.op13_spelling,
)
QUERIES = {f.__name__: f for f in OPERATORS}
SQL: dict[str, str] = {"op1_licenses": licenses.OP1_SQL, "op9_repetition": repetition.OP9_SQL, "op11_collocations": collocations.OP11_SQL, "op12_exact_dedup": exact_dedup.OP12_SQL}
