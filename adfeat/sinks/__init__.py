"""Writers and export views."""
