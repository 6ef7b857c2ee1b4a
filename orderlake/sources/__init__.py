"""Reading under a column contract, staging, publishing."""
