"""pharmaflow: Spark DataFrame operators for drug-safety and patient-record data.

Every operator takes DataFrames (plus keyword parameters) and returns a lazy
DataFrame; nothing is collected except small metric rows where an operator's
contract is a single number.
"""

__version__ = "0.1.0"
