"""Words several reports share."""

# Fixed values.
UNASSIGNED = "нераспределен"
BASE_TARIFF = "%базовый%"
REPORT_DATE_FORMAT = "dd.MM.yyyy"
