"""One pipeline per OMOP output table."""
