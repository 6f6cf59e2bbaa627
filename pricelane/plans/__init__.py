"""One plan per shop: pages or feeds in, output tables out."""
