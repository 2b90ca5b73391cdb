"""Reading source systems, and writing the staging, snapshot and analytics layers."""
