"""The star schema build and the questions answered over it."""
