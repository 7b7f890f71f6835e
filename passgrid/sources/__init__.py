"""Sources: pass records, their decoding, stations, dictionaries."""
