"""Message shapes of the charging event log.  All names and types here are fixed values."""

LOG = """
    message_id string, message_type int, charge_point_id string,
    action string, write_timestamp string, body string
"""

START_REQUEST = "connector_id int, id_tag string, meter_start int, timestamp string, reservation_id int"

START_RESPONSE = """
    transaction_id int,
    id_tag_info struct<status: string, parent_id_tag: string, expiry_date: string>
"""

STOP_REQUEST = """
    meter_stop int, timestamp string, transaction_id int, reason string,
    id_tag string, transaction_data array<string>
"""

METER_VALUES = """
    connector_id int, transaction_id int,
    meter_value array<struct<
        timestamp: string,
        sampled_value: array<struct<
            value: string, context: string, format: string,
            measurand: string, phase: string, unit: string>>>>
"""

STATUS = """
    connector_id int, error_code string, status string, timestamp string,
    info int, vendor_id int, vendor_error_code int
"""

REQUEST, RESPONSE = 2, 3
MAIN_MEASURAND = "Power.Active.Import"
