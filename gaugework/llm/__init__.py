"""Operators for preparing training text: quality, licences, packing, encoding, fingerprints, de-duplication and privacy."""
