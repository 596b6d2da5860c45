
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate as M
from ledgerlens.operators import monitor as MN


def test_class_weights_and_scale_pos_weight():
    n, pos = 2_217_905, 3_955
    assert round(n / (2 * (n - pos)), 4) == 0.5009
    assert round(n / (2 * pos), 4) == 280.3925
    assert round(249_541 / max(459, 1), 2) == 543.66


def test_stratified_cap_and_resampling_sizes():
    assert round(3_471 * 250_000 / 1_889_936) == 459
    assert int(459 / 0.05) + 459 == 9_639
    assert int(0.05 * 249_541) == 12_477


def test_budget_k_and_confusion_arithmetic():
    n = 552_504
    ks = [M.budget_k(n, b) for b in M.REVIEW_BUDGETS]
    assert ks[0] == 553 and ks[-1] == 27_626
    assert round(4_211 / 81_773, 6) == 0.051496
    assert 6_702_594_765 - 353_972 == 6_702_240_793
    assert 532_909 + 2_237_500 == 2_217_905 + 552_504 == 2_770_409


@pytest.mark.parametrize("feature,ref_mean,cur_mean,p_pub", [
    ("young_account", 0.09221720497496512, 0.23404255319148937, 0.0018812908329106709),
    ("is_new_device", 0.08113377263679013, 0.19148936170212766, 0.012290451359085025),
    ("is_night", 0.009099127329619618, 0.3617021276595745, 1.7821437904089353e-134),
])
def test_yates_chi2_reproduces_published_p(spark, feature, ref_mean, cur_mean, p_pub):
    n_ref, n_cur = 2_217_905, 47
    r1, c1 = round(ref_mean * n_ref), round(cur_mean * n_cur)
    row = spark.createDataFrame([(n_ref - r1, r1, n_cur - c1, c1)], "a long, b long, c long, d long")
    chi = MN.chi2_yates([F.col("a").cast("double"), F.col("b").cast("double"), F.col("c").cast("double"), F.col("d").cast("double")])
    p = row.select(M.erfc(F.sqrt(chi / 2.0)).alias("p")).first().p
    assert p == pytest.approx(p_pub, rel=1e-5)


@pytest.mark.parametrize("d,p_pub", [(0.2467349315222574, 0.005254517704443629), (0.20795944725871507, 0.029229547949607526),
                                     (0.27751831359735823, 0.0010819982896508318)])
def test_ks_asymptotic_p_close_to_published(spark, d, p_pub):
    row = spark.createDataFrame([(d,)], "d double")
    p = row.select(MN.ks_pvalue(F.col("d"), F.lit(2_217_905.0), F.lit(47.0)).alias("p")).first().p
    assert p == pytest.approx(p_pub, rel=0.03)
    assert (p < 0.05) == (p_pub < 0.05)


def test_threshold_grid():
    g = M.threshold_grid()
    assert len(g) == 290 and g[0] == 0.0005 and g[99] == 0.05 and g[100] == 0.055 and g[-1] == 1.0
    assert all(b > a for a, b in zip(g, g[1:]))
    assert math.isclose(g[4], 0.0025)
