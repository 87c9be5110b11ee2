"""The trip model, the places it is read from, and the tables it is saved to."""
