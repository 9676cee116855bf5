"""Generic DataFrame operators: entity, date and key columns are arguments."""
