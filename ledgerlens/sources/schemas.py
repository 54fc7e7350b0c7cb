"""Declared schemas of the raw files; money stays text until it is parsed."""

# Column names and types of the raw files, in file order.
TRANSACTIONS = """
    id BIGINT, date TIMESTAMP_NTZ, client_id BIGINT, card_id BIGINT, amount STRING,
    use_chip STRING, merchant_id BIGINT, merchant_city STRING, merchant_state STRING,
    zip DOUBLE, mcc BIGINT, errors STRING
"""

USERS = """
    id BIGINT, current_age INT, retirement_age INT, birth_year INT, birth_month INT,
    gender STRING, address STRING, latitude DOUBLE, longitude DOUBLE,
    per_capita_income STRING, yearly_income STRING, total_debt STRING,
    credit_score INT, num_credit_cards INT
"""

CARDS = """
    id BIGINT, client_id BIGINT, card_brand STRING, card_type STRING, card_number STRING,
    expires STRING, cvv STRING, has_chip STRING, num_cards_issued INT, credit_limit STRING,
    acct_open_date STRING, year_pin_last_changed INT, card_on_dark_web STRING
"""

MCC = "mcc BIGINT, mcc_desc STRING"

LABELS = "id BIGINT, is_fraud TINYINT"
