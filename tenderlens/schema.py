"""Names and constants shared by all operators.

Everything in this module is a fixed value: results depend on these exact
names, orders and numbers.
"""

# Fields a notice search asks for, in request order.
REQUESTED_FIELDS = (
    "notice-identifier",
    "estimated-value-cur-lot",
    "no-negocaition-necessary-lot",
    "direct-award-justification-text-proc",
    "legal-basis",
    "procedure-identifier",
    "winner-size",
    "winner-selection-status",
    "notice-type",
    "estimated-value-cur-proc",
    "total-value",
    "framework-value-notice",
    "subcontracting-percentage",
    "subcontracting-value",
    "direct-award-justification-proc",
    "ipi-measures-applicable-lot",
    "procedure-accelerated",
    "legal-basis-proc",
    "legal-basis-text",
    "eu-registration-number",
    "exclusion-grounds",
    "framework-buyer-categories-lot",
    "dps-usage-lot",
    "accessibility-lot",
    "winner-owner-nationality",
    "organisation-country-buyer",
)

# Euro per unit; the order is also the order in which codes are looked for in a text.
EUR_RATES = {
    "EUR": 1.0,
    "SEK": 0.087,
    "BGN": 0.51,
    "NOK": 0.086,
    "PLN": 0.23,
    "CZK": 0.039,
    "HUF": 0.0026,
    "DKK": 0.13,
    "RON": 0.20,
}

# Ordinal of a bidder size.
SIZE_ORDINALS = {"micro": 1.0, "small": 2.0, "sme": 2.5, "medium": 3.0, "large": 4.0}

# Columns and name fragments that steer column selection.
MONEY_TEXT_COLUMNS = ("total-value", "framework-value-notice", "subcontracting-value")
LINK_FRAGMENTS = ("link", "url", "xml", "html", "pdf")
ML_ID_FRAGMENTS = ("identifier", "id")
ML_MONEY_COLUMNS = ("total-value-eur", "total-value-eur-capped", "total-value-eur-log")
ML_BIDDER_COLUMNS = ("bidder-count", "bidder-size-numeric")
ML_SKIPPED_FRAGMENTS = ("text", "description", "currency", "link")
MODEL_SKIPPED_FRAGMENTS = ("identifier", "id", "code", "date")
CLUSTER_SKIPPED_FRAGMENTS = ("id", "identifier", "code", "status", "is_outlier")

# Names under which the same quantity may appear, first present one wins.
ID_NAMES = ("notice-identifier", "notice_id", "identifier")
COUNTRY_NAMES = ("organisation-country-buyer", "country")
TYPE_NAMES = ("notice-type", "notice_type")
STORED_VALUE_NAMES = ("total-value-eur", "value_eur", "total-value")
METRIC_VALUE_NAMES = ("total-value-eur", "total-value-eur-capped", "value_eur")
CHART_VALUE_NAMES = ("total-value-eur", "total-value-eur-capped", "value_eur", "total-value")

# Columns that scoring adds; they must not be learnt from when a scored table is used as training data.
SCORING_OUTPUTS = ("cluster", "distance", "is_outlier", "outlier_status", "anomaly_score", "prediction_time")

RUN_SCHEMA = (
    "run_id string, model_type string, parameters string, execution_date string, "
    "record_count bigint, outlier_count bigint, outlier_percentage double, notes string"
)
RESULT_SCHEMA = (
    "run_id string, notice_id string, value_eur double, country string, "
    "notice_type string, is_outlier int, anomaly_score double"
)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def first_present(columns, names):
    """The first of ``names`` that is a column, or None."""
    return next((name for name in names if name in columns), None)


def has_fragment(name, fragments):
    return any(fragment in name.lower() for fragment in fragments)
