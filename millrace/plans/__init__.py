"""The catalogue of tables and the end-to-end jobs built from the operators."""
