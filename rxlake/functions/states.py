"""State-code lookup used by the geography report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Claims state code -> two-digit postal-geography code. Codes are text,
# zero-padded; a region without a code maps to None.
STATE_CODES = {
    "00": "04", "01": "01", "02": "02", "03": "04", "04": "05", "05": "06", "06": "08",
    "07": "09", "08": "10", "09": "11", "10": "12", "11": "13", "12": "15", "13": "16",
    "14": "17", "15": "18", "16": "19", "17": "20", "18": "21", "19": "22", "20": "23",
    "21": "24", "22": "25", "23": "26", "24": "27", "25": "28", "26": "29", "27": "30",
    "28": "31", "29": "32", "30": "33", "31": "34", "32": "35", "33": "36", "34": "37",
    "35": "38", "36": "39", "37": "40", "38": "41", "39": "42", "40": "72", "41": "44",
    "42": "45", "43": "46", "44": "47", "45": "48", "46": "49", "47": "50", "48": "78",
    "49": "51", "50": "53", "51": "54", "52": "55", "53": "56", "54": "16", "55": "06",
    "56": "CA", "57": "36", "58": "54", "59": "MX", "64": "60", "65": "66", "66": "69",
    "67": "48", "68": "12", "69": "12", "70": "20", "71": "22", "72": "39", "73": "42",
    "74": "48", "75": "06", "76": "19", "77": "27", "78": "17", "79": "29", "80": "24",
    "81": "09", "82": "25", "83": "34", "84": "72", "85": "13", "86": "37", "87": "45",
    "88": "47", "89": "05", "90": "40", "91": "08", "92": "06", "93": "41", "94": "53",
    "95": "22", "96": "35", "97": "48", "99": None,
    "A0": "37", "A1": "37", "A2": "12", "A3": "22", "A4": "26", "A5": "28", "A6": "39",
    "A7": "42", "A8": "47", "A9": "48", "B0": "21", "B1": "54", "B2": "37",
}


def state_lookup(spark: SparkSession) -> DataFrame:
    """The lookup as a two-column DataFrame (code, fips)."""
    return spark.createDataFrame(list(STATE_CODES.items()), "code string, fips string")
