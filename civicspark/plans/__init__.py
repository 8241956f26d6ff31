"""The layers as DataFrame-to-DataFrame functions, and the job that chains them."""
