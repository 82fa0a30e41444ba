"""Explicit schemas of every input feed."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOLEAN, DATE, TIME = T.BooleanType(), T.DateType(), T.TimestampType()
STRINGS, TEXT_MAP = T.ArrayType(STRING), T.MapType(STRING, STRING)


def record(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    """A schema from ``name=type``; columns are nullable unless required."""
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


POINT = record(lat=DOUBLE, lon=DOUBLE)

PAYMENT = {
    "users": record(user_id=LONG, first_name=STRING, last_name=STRING, email=STRING),
    "merchants": record(merchant_id=LONG, merchant_name=STRING, merchant_category=STRING),
    "locations": record(location_id=LONG, country=STRING, city=STRING),
    "cards": record(card_id=LONG, masked_card_number=STRING),
    "transactions": record(
        transaction_id=LONG, user_id=LONG, merchant_id=LONG, location_id=LONG, card_id=LONG,
        amount=DOUBLE, transaction_date=DATE,
    ),
    "ml_signals": record(ml_signal_id=LONG, transaction_id=LONG, fraud_score=DOUBLE, created_date=DATE),
}

AML = {
    "customer_profile": record(
        ("customer_id",),
        customer_id=STRING, full_name=STRING, date_of_birth=DATE, nationality=STRING,
        primary_address=record(street=STRING, city=STRING, postal_code=STRING, country=STRING),
        contact_info=record(email=STRING, phone=STRING),
        kyc_status=STRING, risk_score=DOUBLE, created_at=TIME, updated_at=TIME, dt=DATE,
    ),
    "account_rel": record(
        ("account_id", "customer_id"),
        account_id=STRING, customer_id=STRING, account_type=STRING, open_date=DATE, status=STRING,
        balance=T.DecimalType(15, 2), currency_code=STRING, branch_id=STRING, last_updated=TIME, dt=DATE,
    ),
    "merchant_data": record(
        ("merchant_id",),
        merchant_id=STRING, legal_name=STRING, categories=STRINGS, risk_level=STRING,
        contact=record(phone=STRING, email=STRING), address=TEXT_MAP,
        created_at=TIME, updated_at=TIME, region=STRING,
    ),
    "transactions": record(
        ("transaction_id",),
        transaction_id=STRING, account_id=STRING, customer_id=STRING, merchant_id=STRING,
        txn_timestamp=TIME, amount=DOUBLE, currency_code=STRING, channel=STRING, geo_location=POINT,
        device_info=TEXT_MAP, status=STRING, dt=DATE, region=STRING,
    ),
    "watchlist": record(
        entity_name=STRING, entity_type=STRING, risk_category=STRING, listing_source=STRING,
        watchlist_date=DATE, notes=STRING, last_updated=TIME, dt=DATE,
    ),
    "device_channel": record(
        device_id=STRING, customer_id=STRING, device_type=STRING, ip_address=STRING, os_version=STRING,
        login_time=TIME, location=POINT, suspicious_flags=STRINGS, environment=STRING,
    ),
    "kyc_questionnaire": record(
        form_id=STRING, customer_id=STRING, question_responses=TEXT_MAP, review_status=STRING,
        last_reviewed_by=STRING, review_date=DATE, updated_at=TIME, dt=DATE,
    ),
    "complaints": record(
        complaint_id=STRING, customer_id=STRING, account_id=STRING, txn_id=STRING, opened_date=TIME,
        complaint_type=STRING, status=STRING, resolution_notes=STRINGS, last_updated=TIME, dt=DATE,
    ),
    "aml_compliance_rules": record(
        rule_id=STRING, description=STRING, threshold_params=TEXT_MAP, effective_date=DATE,
        version=STRING, owner=STRING, updated_at=TIME,
    ),
}

# One superset for every variant of the marketplace tables; ids are text.
MARKETPLACE = {
    "product": record(product_id=STRING, name=STRING, category=STRING, dt=DATE),
    "vendor": record(vendor_id=STRING, name=STRING, region=STRING, dt=DATE),
    "marketplace": record(market_id=STRING, name=STRING, type=STRING, dt=DATE),
    "calendar": record(date=DATE, weekday=STRING, is_weekend=BOOLEAN, day=INT, year=INT, month=INT),
    "orders": record(
        order_id=STRING, product_id=STRING, vendor_id=STRING, market_id=STRING, order_date=TIME,
        order_quantity=LONG, order_amount=DOUBLE, day=INT, year=INT, month=INT,
    ),
    "users": record(
        user_id=STRING, name=STRING, email=STRING, signup_date=DATE, country=STRING, date_of_birth=DATE
    ),
    "merchants": record(merchant_id=STRING, merchant_name=STRING, category=STRING, location=STRING),
    "devices": record(device_id=STRING, device_type=STRING, os=STRING, ip_address=STRING),
    "transactions": record(
        transaction_id=STRING, user_id=STRING, merchant_id=STRING, device_id=STRING, amount=DOUBLE,
        currency=STRING, transaction_time=TIME, transaction_type=STRING,
    ),
    "exchange_rates": record(currency=STRING, rate_to_usd=DOUBLE, date=DATE),
    "geolocation": record(
        ip_address=STRING, country=STRING, region=STRING, city=STRING, latitude=DOUBLE, longitude=DOUBLE
    ),
}

EMR_TRANSACTIONS = record(
    transaction_id=LONG, user_id=STRING, product_id=STRING, timestamp=TIME, amount=DOUBLE
)

# Folder layout: the partition columns of each table.
PARTITIONS = {
    "customer_profile": ("dt",),
    "account_rel": ("dt",),
    "merchant_data": ("region",),
    "transactions": ("dt", "region"),
    "watchlist": ("dt",),
    "device_channel": ("environment",),
    "kyc_questionnaire": ("dt",),
    "complaints": ("dt",),
    "product": ("dt",),
    "vendor": ("dt",),
    "marketplace": ("dt",),
    "calendar": ("year", "month"),
    "orders": ("year", "month"),
}

# Catalogue name of each marketplace folder.
MARKETPLACE_CATALOGUE = {
    "product": "products",
    "vendor": "vendors",
    "marketplace": "marketplaces",
    "calendar": "calendar",
    "orders": "orders_fact",
}
