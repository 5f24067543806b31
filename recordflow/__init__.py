"""recordflow: Spark-native record-migration jobs.

Extracts, incremental pulls with a position ledger, data-quality checks,
CSV / HL7 v2 / FHIR exports and source-to-target reconciliation, all
expressed as DataFrame operations so Catalyst and AQE plan them.
"""

__version__ = "0.1.0"
