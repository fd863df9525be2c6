"""Part of punctual."""
