"""Invariants on the derived test ledger."""

from ledgerline.operators import pairing
from ledgerline.plans.catalog import FINE_SPAN
from ledgerline.plans.inputs import fixture_inputs
from tests.conftest import SF_SMALL


def test_forward_and_backward_pairs_agree(spark):
    led = fixture_inputs(spark, SF_SMALL).ledger
    fwd = pairing.classify_forward(led).where("pair_type = 'DR_with_paired_CR'").count()
    bwd = pairing.classify_backward(led).where("pair_type = 'CR_paired'").count()
    assert fwd == bwd == 390  # FIXTURES.md section 4


def test_fine_split_equals_plain_window(spark):
    led = fixture_inputs(spark, SF_SMALL).ledger
    cols = ["seq", "next_credit", "next_date", "prev_debit", "prev_numbered", "pair_type", "forward_type"]
    plain = pairing.classify_both(led, span=None).select(*cols)
    split = pairing.classify_both(led, span=FINE_SPAN).select(*cols)
    assert plain.count() == split.count() == 2486
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0
