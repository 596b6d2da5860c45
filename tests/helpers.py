"""Small hand-made transaction frames for edge cases (FIXTURES.md §B2)."""

from ledgerlens import schema as S

DEFAULT = dict(
    txn_id=0, step=1, type="TRANSFER", amount=100.0, nameOrig="C1", oldbalanceOrg=100.0, newbalanceOrig=0.0,
    nameDest="C9", oldbalanceDest=0.0, newbalanceDest=100.0, isFraud=0, isFlaggedFraud=0, account_age_days=400,
    home_billing_country="US", home_device_id="dev_00000001", device_id="dev_00000001", is_new_device=0,
    browser_fingerprint="fp_0000000000", shipping_billing_mismatch=0, failed_payment_attempts=0, ip_country="US",
    ip_billing_distance_km=10.0, hour_of_day=1, is_night=1, score=0.1,
)
SCHEMA = (
    "txn_id long, step long, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
    "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int, account_age_days long, "
    "home_billing_country string, home_device_id string, device_id string, is_new_device int, browser_fingerprint string, "
    "shipping_billing_mismatch int, failed_payment_attempts long, ip_country string, ip_billing_distance_km double, "
    "hour_of_day int, is_night int, score double"
)
COLS = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]


def txns(spark, rows):
    out = []
    for i, r in enumerate(rows):
        d = dict(DEFAULT)
        d["txn_id"] = i + 1
        d.update(r)
        out.append(tuple(d[c] for c in COLS))
    return spark.createDataFrame(out, SCHEMA)


def enriched(spark, rows):
    return txns(spark, rows).select(*S.ENRICHED_COLUMNS)
