"""chronofold: point-in-time feature building, data repair and evaluation as DataFrame operators."""
