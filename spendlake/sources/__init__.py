"""Readers, payload decoders and the domain views over the supplied tables."""
