"""Generic DataFrame operators, independent of the airline model."""
